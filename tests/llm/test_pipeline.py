import re
import sys
from pathlib import Path

import cases
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from clickloom.llm.exact_dedup import without_copies  # noqa: E402


def test_copies_stay_once(spark):
    kept = without_copies(cases.docs(spark))
    assert kept.columns == cases.docs(spark).columns
    plain = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    best = {}
    for doc_id, text, *_ in cases.rows():
        rank = (-len(text or ""), doc_id is None, doc_id or 0)
        best[plain(text)] = min(best.get(plain(text), (rank, doc_id)), (rank, doc_id))
    found = {plain(r.text): r.doc_id for r in kept.collect()}
    assert found == {k: v[1] for k, v in best.items()} and kept.count() == len(best)
    assert without_copies(cases.docs(spark, [])).count() == 0


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{i}")
        new = spark.read.parquet(f"{tmp_path}/{i}")
        if name != "packing":
            assert new.columns == docs.columns
            assert new.join(docs, docs.columns, "left_semi").count() == new.count()  # rows pass unchanged
            seen.append(new.count())
        else:
            assert new.select("doc_id").distinct().count() == docs.count()
        docs = new
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.6 * seen[0]
    assert seen[1] > 0.97 * seen[0]
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()


def test_no_column_name_clashes(spark):
    names = ("__id", "__print", "__sha", "kept_id", "kept_print", "bad_id", "of_id", "id", "tie", "print", "sha", "size", "chars", "best", "run", "a.b")
    docs = cases.docs(spark)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns
        for r in kept.collect():
            own = "none" if r.doc_id is None else r.doc_id
            assert [r[name] for name in names] == [f"{i}-{own}" for i in range(len(names))]


def test_the_kept_copy_does_not_depend_on_the_order(spark):
    rows = [(7, "a b", "en", f"s{i}", i, "h", i) for i in range(6)]
    found = {tuple(map(str, without_copies(cases.docs(spark, rows[i:] + rows[:i])).collect())) for i in range(3)}
    assert len(found) == 1


def test_edge_rows_pass_through_all_stages(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(*r[:2], "en", *r[3:]) for r in cases.rows()]
    for data in (rows, []):
        docs = cases.docs(spark, data)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == cases.docs(spark).columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
