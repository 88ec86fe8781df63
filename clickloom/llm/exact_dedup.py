"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is a run: one row per digest with the best copy and the number of
copies.  In each round ``fan_in`` neighbouring runs exchange their rows by digest and are
merged; after the last round one run is left, spread over all tasks by digest.  A digest
held by a third of all rows is one row of each run from the first round on, so no task
ever holds its copies.  With ``fan_in`` 2 the rounds are those of a binomial tree; more
runs at once mean fewer rounds over the same rows.

Rows are equal when SHA-256, a second 64-bit hash and the length of the normalised text
agree; all three are the merge key at every level, so a digest shared by chance would
stay two groups.

Defined results: a null text is an empty one, and all empty texts are one group; of rows
that tie in length the smallest ``doc_id`` stays (null comes last); of rows repeated with
the same id and text exactly one stays.  An empty table gives no rows.  Other columns are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import id_and_text, packed, table, written

# The characters that do not count when texts are compared.
IGNORED = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
KEY = ("sha", "second", "size")


def normalised(text: Column) -> Column:
    for char in IGNORED:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def with_digest(docs: DataFrame) -> DataFrame:
    """The key columns of every row, beside the columns it has."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = normalised(text)
    return docs.withColumns(
        {"sha": F.unhex(F.sha2(plain, 256)), "second": F.xxhash64(plain), "size": F.octet_length(plain)}
    )


def merge_runs(runs: DataFrame, count: int, fan_in: int = 16) -> DataFrame:
    """Rounds of merging until one run is left: (key, best, group_size)."""
    best = F.min("best").alias("best")
    while True:
        runs = runs.withColumn("run", F.floor(F.col("run") / fan_in))
        runs = runs.groupBy("run", *KEY).agg(best, F.sum("group_size").alias("group_size"))
        count = -(-count // fan_in)
        if count <= 1:
            return runs.drop("run")


def exact_duplicates(docs: DataFrame, fan_in: int = 16) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row."""
    rows = with_digest(id_and_text(docs)).select(
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        "doc_id",
        F.length("text").alias("chars"),
        *KEY,
    )
    rows = written(rows, "digest-runs")
    last = rows.agg(F.max("run")).first()[0]
    if last is None:
        last = 0
    # Ascending: most code points, smallest id with null last, one row of repeated ones.
    best = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    runs = rows.select("run", *KEY, best.alias("best"), F.lit(1).cast("long").alias("group_size"))
    groups = merge_runs(runs, last + 1, fan_in).select(
        *KEY, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"
    )
    return rows.join(groups, list(KEY)).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, fan_in: int = 16) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stay: one of each group.

    It is the first by length, id (null last) and a hash of the whole row, so a rerun keeps the same.
    """
    own = with_digest(packed(docs)).withColumn("chars", F.length("text"))
    best = F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("none"), "id")
    runs = own.select(F.spark_partition_id().alias("run"), *KEY, best.alias("best"), F.lit(1).cast("long").alias("group_size"))
    runs = written(runs, "digest-runs")
    last = runs.agg(F.max("run")).first()[0] or 0
    groups = merge_runs(runs, last + 1, fan_in).select(
        *[F.col(k).alias(f"of_{k}") for k in KEY], F.col("best.id").alias("of_id"), (-F.col("best.less")).alias("of_chars")
    )
    stays = [own[k] == groups[f"of_{k}"] for k in KEY] + [own["id"].eqNullSafe(groups["of_id"]), own["chars"] == groups["of_chars"]]
    kept = own.select(*KEY, "id", "chars", "tie", "row").join(groups, stays, "left_semi")
    return kept.groupBy(*KEY).agg(F.min_by("row", "tie").alias("row")).select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


@query("op10_exact_dedup", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))
