import random
import re

import cases
import numpy as np
import pytest

from clickloom.llm.sketches import components, sketch
from clickloom.llm.textcore import mix


def sets(text, size=5):
    ws = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i : i + size]) for i in range(max(len(ws) - size + 1, 1))} if ws else set()


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    own = [(d, sets(t)) for d, t in rows]
    label = list(range(len(own)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, a) in enumerate(own):
        for j in range(i):
            b = own[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(own):
        low.setdefault(find(i), []).append(d)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in low.items()}
    return sorted(((d, len(a), least[find(i)]) for i, (d, a) in enumerate(own)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(seed, base, edits):
    r, ws = random.Random(seed), base.split()
    for _ in range(edits):
        ws[r.randrange(len(ws))] = f"e{r.randrange(10**6)}"
    return " ".join(ws)


def test_every_coordinate_is_filled_and_agrees_as_often_as_sets_do():
    r = np.random.default_rng(3)
    pool = mix(np.arange(1, 5000, dtype=np.uint64))
    for size in (1, 2, 7, 40, 900):
        for share in (0.3, 0.85):
            union = r.choice(pool, size if size < 3 else int(size / share), replace=False)
            a, b = union[:size], union[-size:]
            both = np.concatenate([np.unique(a), np.unique(b)])
            values = sketch(both, np.array([0, len(a), len(both)]), 2000)
            assert (values != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
            real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert abs((values[0] == values[1]).mean() - real) < 0.06


def test_a_sketch_does_not_depend_on_its_neighbours():
    a, b = mix(np.arange(1, 9, dtype=np.uint64)), mix(np.arange(100, 400, dtype=np.uint64))
    both = sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 144)
    assert (both[0] == sketch(a, np.array([0, len(a)]), 144)[0]).all()
    assert (both[1] == sketch(b, np.array([0, len(b)]), 144)[0]).all()


@pytest.mark.parametrize("block", [256, 5])
def test_against_all_pairs(spark, block):
    rows = cases.rows()
    base = cases.prose(77, 200)
    rows += [(200 + i, edited(i, base, 1 + i % 4), *[None] * 5) for i in range(40)]  # a group of near copies
    rows += [(300 + i, edited(i, cases.prose(78 + i % 4, 90), i % 3), *[None] * 5) for i in range(20)]
    rows += [(400 + i, base.upper() if i else base, *[None] * 5) for i in range(4)]
    chain = base.split()
    for i in range(12):  # each close to the one before only
        chain = [*chain[4:], *cases.prose(900 + i, 4).split()]
        rows.append((500 + i, " ".join(chain), *[None] * 5))
    docs = cases.docs(spark, rows)
    for name in ("row", "print", "bands"):
        docs = docs.withColumn(name, docs["hash"])
    assert found(components(docs, block=block)) == brute([r[:2] for r in rows])


def test_threshold_is_exact(spark):
    # 17 of 20 shingles in common is 85 %; 16 of 19 is less.
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words[:24]), *[None] * 5), (2, " ".join(words[:21]), *[None] * 5), (3, " ".join(words[:19]), *[None] * 5)]
    assert brute([r[:2] for r in rows]) == [(1, 20, 1), (2, 17, 1), (3, 15, 1)]
    assert found(components(cases.docs(spark, rows))) == brute([r[:2] for r in rows])
    rows = [(1, " ".join(words[:23]), *[None] * 5), (2, " ".join(words[:20]), *[None] * 5)]
    assert found(components(cases.docs(spark, rows))) == [(1, 19, 1), (2, 16, 2)]


def test_a_very_long_text(spark):
    text = cases.prose(5, 400_000)  # more than one chunk of bytes
    rows = [(1, text, *[None] * 5), (2, text + " and more", *[None] * 5), (3, "short text", *[None] * 5)]
    got = found(components(cases.docs(spark, rows)))
    assert [(d, c) for d, _, c in got] == [(1, 1), (2, 1), (3, 3)]


def test_empty_table(spark):
    assert components(cases.docs(spark, [])).count() == 0
