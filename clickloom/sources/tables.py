"""Warehouse tables and report files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds survive a round trip through text.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

GOLD_SCHEMA = (
    "transaction_id string, user_id string, revenue double, conversion_time timestamp, "
    "first_click_channel string, last_click_channel string"
)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``, or in the warehouse where that is unset; a
    cluster shares both.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def replace_table(df: DataFrame, name: str, path: str, partition: str | None = "event_date") -> DataFrame:
    """Create or replace a Parquet table at a path; returns the table.

    Rows are brought together by partition value before the write, each value spread
    over as many tasks as its size asks for (adaptive rebalancing), so a large day is
    neither one task nor thousands of small files.
    """
    spark = df.sparkSession
    if partition is None:
        df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    else:
        even = df.hint("rebalance", F.col(partition))
        even.write.mode("overwrite").format("parquet").option("path", path).partitionBy(partition).saveAsTable(name)
    return spark.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition: str = "event_date") -> None:
    """Replace only the partitions present in ``df``; a rerun gives the same table."""
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, *shards: str) -> DataFrame:
    """A Parquet table, or those of its partition folders the shard globs name."""
    if not shards:
        return spark.read.parquet(path)
    return spark.read.option("basePath", path).parquet(*[f"{path}/{s}" for s in shards])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; arrays and maps become JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]
    writer = df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("timestampFormat", CSV_TIME).csv(path)


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(GOLD_SCHEMA).option("header", True).option("escape", '"')
    return reader.option("timestampFormat", CSV_TIME).csv(path)
