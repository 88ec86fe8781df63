"""What the operators share on the driver's side: inputs, written intermediates, row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.tables import shared_folder

# Rows handed to Python at once; documents can be long, and a batch is held whole.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep the Arrow batches of this session small enough for long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends here, and every reader sees the same rows."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever else the input carries; null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def packed(docs: DataFrame) -> DataFrame:
    """``row``, the whole row, beside ``id``, ``text`` and ``tie``, a hash of the row: no name of ``docs`` can clash with a helper."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"), row.alias("row")).withColumn(
        "tie", F.xxhash64(F.col("row").cast("string"))
    )


def fold(doc_id: str = "doc_id", folds: int = 5):
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds
