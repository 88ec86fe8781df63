"""Daily summary, anomaly scores, incremental attribution, masking and deletion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.config import SQL, Settings
from clickloom.functions.fields import change_from_previous, money
from clickloom.operators.attribution import attribute
from clickloom.operators.conversions import conversion_events, conversions
from clickloom.operators.normalize import is_conversion
from clickloom.operators.sessions import build_sessions

REVENUE_DROP = 0.20
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
DIGITS_PATTERN = r"\d{9,}"


def daily_summary(staged: DataFrame) -> DataFrame:
    """(event_date, events, users, purchases, revenue), the table dashboards read.

    Events are folded per (day, user) first, which makes the distinct count an ordinary
    one and leaves nothing of a hot user but one row a day.
    """
    per_user = staged.groupBy("event_date", "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(is_conversion()).alias("purchases"),
        F.sum(F.when(is_conversion(), money(F.col("revenue")))).alias("revenue"),
    )
    return per_user.groupBy("event_date").agg(
        F.sum("events").alias("events"),
        F.count(F.lit(1)).alias("users"),
        F.sum("purchases").alias("purchases"),
        F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
    )


def anomaly_scores(daily: DataFrame, column: str, days: int = 7, limit: float = 3.0) -> DataFrame:
    """Daily rows with the z-score of a column against the rows before; one row per day."""
    before = Window.orderBy("event_date").rowsBetween(-days, -1)
    value = F.col(column).cast("double")
    score = F.try_divide(value - F.avg(value).over(before), F.stddev_samp(value).over(before))
    return daily.select("event_date", F.col(column), score.alias("score")).withColumn(
        "anomaly", F.coalesce(F.abs("score") > limit, F.lit(False))
    )


def revenue_alerts(daily: DataFrame, drop: float = REVENUE_DROP) -> DataFrame:
    """Days whose revenue fell by more than the given share against the day before."""
    change = change_from_previous(F.col("revenue"), Window.orderBy("event_date"))
    return daily.select("event_date", "revenue", change.alias("change")).where(F.col("change") < -drop)


def weekly_report(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.to_date(F.date_trunc("week", "event_date")).alias("week")).agg(
        F.sum("events").alias("events"),
        F.sum("purchases").alias("purchases"),
        F.sum(money(F.col("revenue"))).cast("double").alias("revenue"),
    )


def attribute_since(staged: DataFrame, since: str, settings: Settings = SQL) -> DataFrame:
    """Attribution of conversions from a date on, reading sessions of the overlap only.

    The overlap is the lookback plus one timeout.  A session cut at its start appears to
    begin within that timeout, that is before every window, and so did the real one;
    all later session starts are true.  Conversions are taken from the whole history,
    because an old event can hold the highest revenue of a transaction seen again.
    """
    start = F.lit(since).cast("timestamp")
    margin = F.expr(f"INTERVAL {settings.lookback_days} DAYS") + F.expr(f"INTERVAL {settings.timeout_minutes} MINUTES")
    overlap = staged.where((F.col("event_date") >= F.to_date(start - margin)) & (F.col("event_ts") >= start - margin))
    keys = conversion_keys(settings)
    seen = conversion_events(staged.where(F.col("event_date") >= F.to_date(start)), settings).select(*keys).distinct()
    events = conversion_events(staged, settings).alias("e").join(seen.alias("s"), same("s", "e", keys), "left_semi")
    fresh = conversions(events, settings).where(F.col("conversion_ts") >= start)
    return attribute(fresh, build_sessions(overlap, settings), settings)


def conversion_keys(settings: Settings) -> list[str]:
    return ["transaction_id", "user_id"] if settings.conversion_dedupe == "latest" else ["transaction_id"]


def same(left: str, right: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def _before(gold: DataFrame, fresh: DataFrame, since: str, settings: Settings, how: str) -> DataFrame:
    """Gold rows before a date, with or without a row of their transaction in ``fresh``."""
    keys = conversion_keys(settings)
    old = gold.where(F.col("conversion_time") < F.lit(since).cast("timestamp"))
    return old.alias("g").join(fresh.select(*keys).alias("f"), same("g", "f", keys), how)


def moved(gold: DataFrame, fresh: DataFrame, since: str, settings: Settings = SQL) -> DataFrame:
    """Gold rows before a date whose transaction was seen again from it on: ``fresh`` holds them anew."""
    return _before(gold, fresh, since, settings, "left_semi")


def stale_days(gold: DataFrame, fresh: DataFrame, since: str, settings: Settings = SQL) -> DataFrame:
    """(event_date) of the days before a date that lose a row, and so have to be written again."""
    return moved(gold, fresh, since, settings).select(F.to_date("conversion_time").alias("event_date")).distinct()


def merged_gold(gold: DataFrame, fresh: DataFrame, since: str, settings: Settings = SQL) -> DataFrame:
    """The gold table after a run from a date on: ``fresh`` replaces that period and what moved into it.

    A transaction bought again later has one row, as if all had been attributed at once.
    """
    return _before(gold, fresh, since, settings, "left_anti").unionByName(fresh)


def masked(events: DataFrame, salt: str) -> DataFrame:
    """Personal data replaced: ids by salted hashes, e-mails and long numbers by marks."""

    def hashed(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.sha2(F.concat(F.lit(salt), F.col(column)), 256))

    def scrubbed(column: str) -> Column:
        return F.regexp_replace(F.regexp_replace(column, EMAIL_PATTERN, "<email>"), DIGITS_PATTERN, "<number>")

    ids = {c: hashed(c) for c in ("client_id", "clientId", "user_id") if c in events.columns}
    texts = {c: scrubbed(c) for c in ("page_url", "referrer", "event_data") if c in events.columns}
    return events.withColumns(ids | texts)


def without_users(events: DataFrame, requests: DataFrame, user: str = "user_id") -> DataFrame:
    """Events of all users but the ones on the deletion list; rows without a user stay."""
    listed = requests.select(F.col(user)).distinct()
    return events.join(listed, user, "left_anti")
