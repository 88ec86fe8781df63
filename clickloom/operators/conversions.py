"""Conversions: purchase events, one row per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.config import SQL, Settings
from clickloom.operators.normalize import is_conversion


def conversion_events(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Events that may become a conversion under the chosen rule."""
    kept = F.col("transaction_id").isNotNull() if settings.conversion_dedupe == "latest" else F.col("revenue") > 0
    return events.where(is_conversion() & kept)


def latest_per_user(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Per (transaction, user): latest time and highest revenue."""
    revenue = F.col("revenue") if settings.null_revenue == "sql" else F.coalesce("revenue", F.lit(0.0))
    return (
        conversion_events(events, settings)
        .groupBy("transaction_id", "user_id")
        .agg(F.max("event_ts").alias("conversion_ts"), F.max(revenue).alias("revenue"))
    )


def earliest_per_transaction(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Per transaction: its oldest row.  All rows without an id form one group.

    An ordered aggregate instead of a ranking window, so that group, which can be very
    large, is reduced before the shuffle.
    """
    oldest = F.min_by(
        F.struct("user_id", F.col("event_ts").alias("conversion_ts"), "revenue"),
        F.struct("event_ts", "event_key"),
    )
    return (
        conversion_events(events, settings)
        .groupBy("transaction_id")
        .agg(oldest.alias("row"))
        .select("transaction_id", "row.user_id", "row.conversion_ts", "row.revenue")
    )


def conversions(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """transaction_id, user_id, conversion_ts, revenue."""
    pick = latest_per_user if settings.conversion_dedupe == "latest" else earliest_per_transaction
    return pick(events, settings)
