"""Per-customer and per-cohort tables.

Everything is folded to one row per user and day before any window, so a window
partition is bounded by the covered days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.fields import money


def daily_purchases(purchases: DataFrame, user: str, moment: str, amount: str) -> DataFrame:
    """(user_id, day, purchases, revenue)."""
    return purchases.groupBy(F.col(user).alias("user_id"), F.to_date(moment).alias("day")).agg(
        F.count(F.lit(1)).alias("purchases"), F.sum(money(F.col(amount))).alias("revenue")
    )


def with_cohort(daily: DataFrame, unit: str = "week", bucket_days: int = 7) -> DataFrame:
    """Daily purchases with the cohort of the user's first one and the age in buckets."""
    first = F.min("day").over(Window.partitionBy("user_id"))
    return (
        daily.withColumn("first_day", first)
        .withColumn("cohort", F.to_date(F.date_trunc(unit, "first_day")))
        .withColumn("bucket", F.floor(F.datediff("day", "first_day") / bucket_days))
    )


def cohort_retention(daily: DataFrame, unit: str = "week", bucket_days: int = 7) -> DataFrame:
    """(cohort, bucket, users): users of a cohort who bought in an age bucket."""
    return with_cohort(daily, unit, bucket_days).groupBy("cohort", "bucket").agg(F.count_distinct("user_id").alias("users"))


def retention_table(daily: DataFrame, buckets: int | None = None, unit: str = "week", bucket_days: int = 7) -> DataFrame:
    """The same with one column per bucket: the first ``buckets``, or all there are (found by a job of its own)."""
    wanted = None if buckets is None else list(range(buckets))
    return (
        cohort_retention(daily, unit, bucket_days)
        .groupBy("cohort")
        .pivot("bucket", wanted)
        .agg(F.first("users"))
        .fillna(0)
    )


def customer_value(daily: DataFrame, as_of: str) -> DataFrame:
    """(user_id, recency_days, frequency, revenue, first_day)."""
    return daily.groupBy("user_id").agg(
        F.datediff(F.lit(as_of).cast("date"), F.max("day")).cast("bigint").alias("recency_days"),
        F.sum("purchases").alias("frequency"),
        F.sum("revenue").cast("double").alias("revenue"),
        F.min("day").alias("first_day"),
    )


def cohort_value(daily: DataFrame, unit: str = "week", bucket_days: int = 7) -> DataFrame:
    """(cohort, bucket, revenue, cumulative_revenue)."""
    per_bucket = with_cohort(daily, unit, bucket_days).groupBy("cohort", "bucket").agg(F.sum("revenue").alias("revenue"))
    by_age = Window.partitionBy("cohort").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return per_bucket.withColumn("cumulative_revenue", F.sum("revenue").over(by_age))


def purchase_frequency(daily: DataFrame, days: int = 30) -> DataFrame:
    """(user_id, day, purchases_window, revenue_window): sums of the days up to each day."""
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    recent = Window.partitionBy("user_id").orderBy("day_number").rangeBetween(1 - days, 0)
    return daily.withColumn("day_number", number).select(
        "user_id",
        "day",
        F.sum("purchases").over(recent).alias("purchases_window"),
        F.sum("revenue").over(recent).cast("double").alias("revenue_window"),
    )


def churn_labels(events: DataFrame, as_of: str, inactive_days: int = 14) -> DataFrame:
    """(user_id, last_day, churned): no event in the days before ``as_of``."""
    last = events.where(F.to_date("event_ts") <= F.lit(as_of).cast("date")).groupBy("user_id").agg(
        F.max(F.to_date("event_ts")).alias("last_day")
    )
    return last.withColumn("churned", F.datediff(F.lit(as_of).cast("date"), "last_day") > inactive_days)


def two_variant_test(subjects: DataFrame, variant: Column, success: Column, critical: float = 1.959964) -> DataFrame:
    """One row: rates of variants A and B, z of their difference, whether it is significant."""
    a, b = variant == "A", variant == "B"
    n = subjects.agg(
        F.count_if(a).alias("n_a"),
        F.count_if(b).alias("n_b"),
        F.count_if(a & success).alias("s_a"),
        F.count_if(b & success).alias("s_b"),
    )
    pooled = F.try_divide(F.col("s_a") + F.col("s_b"), F.col("n_a") + F.col("n_b"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("n_a")) + F.try_divide(F.lit(1), F.col("n_b"))))
    difference = F.try_divide(F.col("s_b"), F.col("n_b")) - F.try_divide(F.col("s_a"), F.col("n_a"))
    return n.withColumn("z", F.try_divide(difference, error)).withColumn("significant", F.abs("z") > critical)
