"""Abandoned carts: a cart event with no later cart or purchase event soon after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.fields import time_slice
from clickloom.operators.normalize import is_conversion

CART_EVENT = "product_added_to_cart"
WAIT_MINUTES = 60


def cart_activity(staged: DataFrame) -> DataFrame:
    """Cart and purchase events only."""
    return staged.where((F.col("event_name") == CART_EVENT) | is_conversion()).withColumn(
        "is_cart", F.col("event_name") == CART_EVENT
    )


def abandoned_carts(staged: DataFrame, wait_minutes: int = WAIT_MINUTES) -> DataFrame:
    """(user_id, cart_ts): the user's next cart or purchase event is more than the wait away.

    Inside a time slice no longer than the wait only the last event can qualify, so
    events are folded per (user, slice) first and the window sees folded rows only.
    """
    folded = (
        cart_activity(staged)
        .where(F.col("event_ts").isNotNull())
        .groupBy("user_id", time_slice(F.col("event_ts"), wait_minutes * 60).alias("slice"))
        .agg(
            F.min("event_ts").alias("first_ts"),
            F.max("event_ts").alias("last_ts"),
            F.max_by("is_cart", F.struct("event_ts", "event_key")).alias("ends_in_cart"),
        )
    )
    following = F.lead("first_ts").over(Window.partitionBy("user_id").orderBy("slice"))
    wait = F.expr(f"INTERVAL {wait_minutes} MINUTES")
    return (
        folded.withColumn("next_ts", following)
        .where(F.col("ends_in_cart") & (F.col("next_ts").isNull() | (F.col("next_ts") > F.col("last_ts") + wait)))
        .select("user_id", F.col("last_ts").alias("cart_ts"))
    )
