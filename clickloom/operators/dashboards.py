"""The tables behind the dashboards.  ``as_of`` is the moment the dashboard is looked at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.channels import is_paid
from clickloom.functions.fields import change_from_previous, money_sum, money_total

DROP_LIMIT = 0.30
PAID_FLOOR = 1.0
ALERTS_SHOWN = 50


def moment_of(as_of) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def since(column: str, as_of, **ago: int) -> Column:
    """The column lies at most so many days or hours before ``as_of``."""
    ((unit, count),) = ago.items()
    return F.col(column) >= moment_of(as_of) - F.expr(f"INTERVAL {count} {unit.upper()}")


def daily_revenue(gold: DataFrame, as_of=None, days: int | None = 14) -> DataFrame:
    return (
        gold.where(F.lit(True) if days is None else since("conversion_time", as_of, days=days))
        .groupBy(F.to_date("conversion_time").alias("day"))
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy("day")
    )


def revenue_drops(gold: DataFrame, as_of=None, days: int = 14, limit: float = DROP_LIMIT) -> DataFrame:
    """Days whose revenue fell by more than the limit against the day before."""
    daily = daily_revenue(gold, as_of, days)
    change = change_from_previous(F.col("revenue"), Window.orderBy("day"))
    return daily.withColumn("change", change).where(F.col("change") < -limit)


def channel_mix(gold: DataFrame, as_of=None, days: int | None = 7) -> DataFrame:
    return (
        gold.where(F.lit(True) if days is None else since("conversion_time", as_of, days=days))
        .groupBy(F.col("last_click_channel").alias("channel"))
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy(F.desc("revenue"), "channel")
    )


def paid_revenue_today(gold: DataFrame, as_of=None) -> DataFrame:
    """One row: paid revenue of the day, 0 if none, and whether that calls for an alert."""
    return (
        gold.where((F.to_date("conversion_time") == F.to_date(moment_of(as_of))) & is_paid(F.col("last_click_channel")))
        .agg(money_total(F.col("revenue")).alias("paid_revenue"))
        .withColumn("alert", F.col("paid_revenue") < PAID_FLOOR)
    )


def event_volume(staged: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    return (
        staged.where(since("event_ts", as_of, days=days))
        .groupBy(F.to_date("event_ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("day")
    )


def latest_alerts(alerts: DataFrame, as_of=None, hours: int = 24, shown: int = ALERTS_SHOWN) -> DataFrame:
    """The newest alerts of the last day: a top-k, kept per task before it is merged."""
    return (
        alerts.where(since("timestamp", as_of, hours=hours))
        .select("timestamp", "severity", "code", "message")
        .orderBy(F.desc("timestamp"), "severity", "code", "message")
        .limit(shown)
    )
