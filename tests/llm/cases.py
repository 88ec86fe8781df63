"""Small inputs every operator must stand: nulls, empty and long texts, ties, repeats, clashing names."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, row int"

WORDS = "the of and re tion eau que der die ung ést ñá über thing 12 a,b it's DON'T x. <|endoftext|>".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice(WORDS) for _ in range(r.randint(1, 3))) for _ in range(n))


def rows():
    texts = [None, "", " \t\n", "a b", "A  b", "ab  c", "\x1cx \x85y", prose(1, 40), prose(1, 40), prose(2, 9000)]
    texts += [prose(1, 40).replace(" ", "\n"), prose(3, 30) + " " + prose(1, 40), "½ ﬁ İ ς Σ é", "ab"]
    out = [(i, t, "en" if i % 2 else None, None, None, "h", i) for i, t in enumerate(texts)]
    out += [(3, "a b", "fr", "s", 1, None, None), (3, "a b", "fr", "s", 1, None, None)]  # a repeated row
    out += [(None, "a b", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return out


def docs(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCS).repartition(3)
