"""Repeated rows and repeated transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.fields import first_truthy_of, with_parsed
from clickloom.operators.normalize import is_conversion


def distinct_rows(events: DataFrame) -> DataFrame:
    """Each distinct full row once; copies are merged before the shuffle."""
    return events.dropDuplicates()


def duplicate_rows(events: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(by, duplicate_rows): rows after the first in every group of equal rows.

    Shuffling whole rows of a table to find a handful of copies is the expensive way.
    The first pass shuffles a 64-bit row hash only; the rows of repeated hashes are then
    compared in full, so a hash collision cannot change the count.
    """
    rows = events.select(F.col(by), *[F.col(c) for c in columns if c != by])
    hashed = rows.withColumn("row_hash", F.xxhash64(*[F.col(c) for c in rows.columns]))
    suspects = hashed.groupBy("row_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_hash")
    return (
        hashed.join(suspects, "row_hash", "left_semi")
        .groupBy(*rows.columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(by)
        .agg(F.sum(F.col("n") - 1).alias("duplicate_rows"))
        .where("duplicate_rows > 0")
    )


# The report takes the order id where there is no transaction id.
REPORT_KEYS = ("transaction_id", "order_id")


def payload_transactions(events: DataFrame, *keep: str, keys: Sequence[str] = REPORT_KEYS) -> DataFrame:
    """(keep..., transaction): id of every conversion event that states one."""
    conversions, parsed = with_parsed(events.where(is_conversion()))
    return (
        conversions.select(*keep, first_truthy_of(F.col(parsed), keys).alias("transaction"))
        .where(F.col("transaction").isNotNull())
    )


def duplicate_transactions(events: DataFrame, by: str, keys: Sequence[str] = REPORT_KEYS) -> DataFrame:
    """(transaction, by, occurrences): every place of a transaction seen more than once.

    Occurrences are counted per (transaction, place) before the totals, so a transaction
    repeated without end stays a handful of rows.
    """
    placed = (
        payload_transactions(events, by, keys=keys)
        .groupBy("transaction", by)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    repeated = (
        placed.groupBy("transaction").agg(F.sum("occurrences").alias("n")).where("n > 1").select("transaction")
    )
    return placed.join(repeated, "transaction", "left_semi")


def duplicate_transaction_count(events: DataFrame, by: str) -> DataFrame:
    """One row: number of events whose transaction occurs more than once; 0 if none."""
    return duplicate_transactions(events, by).agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("duplicate_transaction_rows")
    )
