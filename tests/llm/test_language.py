import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm.language import GRAMS, codewords, grams, identify, train, with_language


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 40])
def test_codewords_are_far_apart(n):
    code = codewords(n)
    distance = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert distance >= (1 if n == 2 else 2) and (n != 4 or distance == 4)


def test_grams_do_not_cross_rows():
    data = np.frombuffer(b"abcabx", np.uint8)
    found = grams(data, np.array([0, 3, 3, 6]))
    assert (found[0] == GRAMS).tolist() == [False, False, True, False, False, True]
    assert (found[1] == GRAMS).tolist() == [False, True, True, False, True, True]
    assert found[0, 0] == found[0, 3]


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, clear, n = found.agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg((~F.col("ambiguous")).cast("int")), F.count("*")
    ).first()
    assert n > 20 and right > 0.95 and clear > 0.95
    assert with_language(docs).count() > 0.95 * docs.count()


def test_cases(spark):
    rows = [(i, t, "en" if i % 2 else "fr", *r[3:]) for i, (t, r) in enumerate((r[1], r) for r in cases.rows())]
    rows += [(100, "12 34 ...", "en", *[None] * 4), (101, "日本語", None, *[None] * 4)]
    found = {r.doc_id: r for r in identify(cases.docs(spark, rows)).collect()}
    assert len(found) == len(rows)
    for doc_id, text, *_ in rows:
        r = found[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, text or "")))
        assert 0 <= r.score <= 1
    kept = with_language(cases.docs(spark, rows))
    assert kept.columns == cases.docs(spark).columns


def test_nothing_to_learn_from(spark):
    rows = [(1, "a b", None, *[None] * 4), (None, None, None, *[None] * 4)]
    assert {r.lang_pred for r in identify(cases.docs(spark, rows)).collect()} == {"und"}
    one = [(i, "a b", "en", *[None] * 4) for i in range(9)]
    assert {tuple(r)[2:4] for r in identify(cases.docs(spark, one)).collect()} == {("en", 1.0)}
    assert train(cases.docs(spark, [])) is None
    assert identify(cases.docs(spark, [])).count() == 0
