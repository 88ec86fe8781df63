import re

import cases
from pyspark.sql import functions as F

from clickloom.llm import decontamination
from clickloom.llm.decontamination import leaks, without_leaks

ITEMS = [
    (1, "Yesterday the old baker Anna sold 12 loaves of bread to her friend Bruno for 3.50 euros, and then Anna closed the shop."),
    (2, "a short one"),
    (3, None),
    (4, ""),
    (5, "two trains leave at the same moment and meet after some time on the long way home"),
    (5, "two trains leave at the same moment and meet after some time on the long way home"),
]


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, doc_id string")


def docs(spark, texts):
    return cases.docs(spark, [(i, t, *[None] * 5) for i, t in enumerate(texts)])


def found(spark, texts):
    return {(r.doc_id, r.item_id): r for r in leaks(docs(spark, texts), benchmark(spark)).collect()}


def test_verbatim_reworded_and_inconsistent(spark):
    item = ITEMS[0][1]
    other = item.replace("Anna", "Clara").replace("Bruno", "Dora").replace("12", "7").replace("3.50", "9")
    broken = item.replace("Anna sold", "Clara sold").replace("12", "7").replace("Bruno", "Anna")
    texts = [f"Well, some text before. {item} And some after.", f"{cases.prose(1, 50)}.\n{other} {cases.prose(2, 50)}", broken,
             cases.prose(3, 500), None, "", ITEMS[4][1].upper(), " ".join(ITEMS[4][1].split()[:9]), "this is a short one too",
             f"{item} x {item}"]
    got = found(spark, texts)
    assert set(got) == {(0, 1), (1, 1), (6, 5), (8, 2), (9, 1)}
    assert got[0, 1].share == 1.0 and not got[0, 1].reworded and got[1, 1].reworded
    kept = without_leaks(docs(spark, texts), benchmark(spark))
    assert kept.columns == cases.docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 7]


def test_insertion_splits_the_alignment_only(spark):
    words = ITEMS[4][1].split()
    assert (0, 5) in found(spark, [" ".join([*words[:2], "slowly", *words[2:]])])


def test_capitals_beyond_ascii(spark):
    """A text in capitals throughout is found; a name with an accent fills a slot."""
    item = "éai éonlée pour an éonqueê aivi ai, éenaitre oiaux éoiré anvitre ñandú Ωmega Жуков"
    other = "on a vu que la grande maison de Élodie reste vide pendant les trois mois"
    rows = [(1, item), (2, other)]
    texts = [item.upper(), other.replace("Élodie", "Ñora"), other.replace("Élodie", "İstanbul")]
    got = {(r.doc_id, r.item_id): r for r in leaks(docs(spark, texts), benchmark(spark, rows)).collect()}
    assert {(0, 1), (1, 2)} <= set(got) and got[1, 2].reworded and got[0, 1].share == 1.0


def test_text_rich_in_numbers(spark):
    """Windows go on until they hold enough words; an item of numbers alone is found by plain windows only."""
    rows = [(1, "what is 12 plus 30 times 4 minus 7 over 3 plus 55 times 2 plus 8 minus 9 over 6 times 41"), (2, "1 2 3 4 5 6 7 8 9 10 11 12")]
    other = "what is 13 plus 31 times 5 minus 8 over 4 plus 56 times 3 plus 9 minus 10 over 7 times 42"
    mixed = "what is 13 plus 13 times 5 minus 8 over 4 plus 56 times 3 plus 9 minus 8 over 7 times 42"
    texts = [f"a {other} b", mixed, rows[0][1], "2 3 4 5 6 7 8 9 10 11 12 13 14", "so 1 2 3 4 5 6 7 8 9 10 11 12"]
    got = {(r.doc_id, r.item_id): r for r in leaks(docs(spark, texts), benchmark(spark, rows)).collect()}
    assert {(0, 1), (2, 1), (3, 2), (4, 2)} == set(got) and got[0, 1].reworded and not got[2, 1].reworded


def test_a_phrase_many_items_share(spark):
    """Brute force over plain windows; pairs are made by the rarer half of an item's windows alone."""
    phrase = "read the next question with care and write down the one right answer to it"
    rows = [(i, f"{phrase} {cases.prose(500 + i, 20)}") for i in range(30)] + [(None, f"{phrase} {cases.prose(900, 20)}"), (99, "one two three")]
    texts = [f"{phrase} {cases.prose(600 + i, 20)}" for i in range(20)] + [rows[3][1], rows[30][1], f"x {rows[4][1].split(' ', 6)[6]} y", "Zero one two three"]
    got = {(r.doc_id, r.item_id) for r in leaks(docs(spark, texts), benchmark(spark, rows)).collect()}

    def grams(text):
        ws = re.findall(r"[a-z0-9\x80-\U0010ffff]+(?:[.,](?<=[0-9].)(?=[0-9])[0-9]+)*", text.lower())
        size = min(8, max(len(ws), 1))
        return [tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)], size, ws

    want = set()
    for d, text in enumerate(texts):
        for item, said in rows:
            own, size, _ = grams(said)
            ws = grams(text)[2]
            held = {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}
            if sum(g in held for g in own) >= 0.5 * len(own):
                want.add((d, item))
    assert {(20, 3), (21, None), (22, 4), (23, 99)} <= want <= got and len(got) <= len(want) + 2
    probes = decontamination.probes_of(
        decontamination.template_windows(benchmark(spark, rows).select("item_id", "text"), ["item_id"], range(1, 9), 5).withColumn("item", F.struct("item_id")), 0.5
    )
    assert probes.groupBy("hash").count().agg(F.max("count")).first()[0] < 30


def test_planted_passages(spark, sf_dir):
    """Brute force: documents that hold a whole item, word for word."""
    items = [(r.item_id, " ".join(r.text.split())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {(r.doc_id, i) for r in table.collect() for i, t in items if t in " ".join((r.text or "").split())}
    got = {(r.doc_id, r.item_id) for r in leaks(table, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert want and want <= got
    assert len(got) <= len(want) + 2


def test_cases_and_empty_tables(spark):
    assert leaks(cases.docs(spark), benchmark(spark)).count() == 0
    assert leaks(cases.docs(spark, []), benchmark(spark)).count() == 0
    assert leaks(cases.docs(spark), benchmark(spark, [])).count() == 0
    assert without_leaks(cases.docs(spark), benchmark(spark, [])).count() == len(cases.rows())
