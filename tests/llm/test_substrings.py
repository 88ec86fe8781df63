import hashlib
import re

import cases
import pytest

from clickloom.llm.substrings import ROWS, RUN, candidates, drop_repeats, keyed


def brute(rows, size):
    """rows: (doc_id, text); texts that share an id must be the same."""
    first, docs = {}, {}
    for doc_id, text in rows:
        docs[doc_id] = re.findall("[^\x20\x09-\x0d]+", text or "")
    for doc_id, ws in docs.items():
        for i in range(len(ws) - size + 1):
            key = tuple(ws[i : i + size])
            at = (doc_id is None, doc_id or 0, i)
            first[key] = min(first.get(key, at), at)
    out = []
    for doc_id, _ in rows:
        ws = docs[doc_id]
        gone = set()
        for i in range(len(ws) - size + 1):
            if first[tuple(ws[i : i + size])] < (doc_id is None, doc_id or 0, i):
                gone.update(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((doc_id, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "many"), [(20, 1000), (20, 2), (5, 3)])
def test_against_brute_force(spark, size, many):
    rows = [r for r in cases.rows() if r[0] is not None] + [(None, cases.prose(1, 40), None, None, None, None, None)]
    loop = " ".join(["a b c d e f g"] * 30)
    rows += [(100 + i, f"{cases.prose(50 + i, 15)} {cases.prose(9, 60)} {loop if i % 3 else ''}", *[None] * 5) for i in range(20)]
    found = drop_repeats(cases.docs(spark, rows), size, many=many)
    assert sorted(map(tuple, found.collect()), key=str) == brute([r[:2] for r in rows], size)


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b = cases.prose(1, 40), cases.prose(2, 40)
    found = drop_repeats(cases.docs(spark, [(1, a, *[None] * 5), (1, b, *[None] * 5), (2, b, *[None] * 5)]))
    assert sorted(r[2] for r in found.collect()) == [0, 0, 40]


def test_full_sketch_loses_nothing(spark):
    rows = [(i, cases.prose(i % 30, 60), *[None] * 5) for i in range(60)]
    docs = cases.docs(spark, rows)
    found = drop_repeats(docs, max_cells=1 << 16)
    assert sorted(map(tuple, found.collect()), key=str) == brute([r[:2] for r in rows], 20)


def test_empty_table(spark):
    assert drop_repeats(cases.docs(spark, [])).count() == 0


def test_windows_in_a_row_are_sent_together(spark):
    """A row for every repeated window made shuffle and disk grow beyond four times the input."""
    import numpy as np
    from pyspark.sql import functions as F

    rows = [(i, cases.prose(7, 400), *[None] * 5) for i in range(4)] + [(9, "a " * 400, *[None] * 5)]
    docs, cells = keyed(cases.docs(spark, rows)), 1 << 16
    everything = spark.sparkContext.broadcast((np.full(ROWS * cells // 8, 255, np.uint8),) * 2)
    runs = candidates(docs, 20, cells, everything, 4)
    n, windows, longest = runs.agg(F.count("*"), F.sum(F.size("h1")), F.max(F.size("h1"))).first()
    assert windows == 5 * (400 - 20 + 1)
    assert n < windows / 4
    assert longest <= RUN
