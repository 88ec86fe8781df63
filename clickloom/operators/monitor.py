"""Daily monitor: alerts and a GREEN / YELLOW / RED status per checked date."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import fields
from clickloom.functions.channels import is_paid
from clickloom.operators.normalize import fold_aliases

# Required columns, thresholds, the label of uncredited revenue, and the
# severity each status stands for.
RAW_COLUMNS = ("client_id", "timestamp", "page_url", "referrer")
GOLD_COLUMNS = ("transaction_id", "revenue", "first_click_channel", "last_click_channel", "conversion_time")
PAID_REVENUE_FLOOR = 1000.0
VOLUME_DEVIATION = 0.50
VOLUME_DAYS = 7
NULL_ID_LIMIT = 0.05
NO_REFERRER_LIMIT = 0.90
UNATTRIBUTED_LIMIT = 0.40
UNATTRIBUTED = "Unattributed"
STATUSES = ("GREEN", "YELLOW", "RED")

ALL_DATES = "all"


def volume_stats(raw: DataFrame) -> DataFrame:
    """(event_date, count, rolling_avg): mean of the up to seven days with data before.

    The window runs over one row per day.
    """
    before = Window.orderBy("event_date").rowsBetween(-VOLUME_DAYS, -1)
    return (
        raw.groupBy(F.to_date(fields.instant(raw, "timestamp")).alias("event_date"))
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("event_date").isNotNull())
        .withColumn("rolling_avg", F.avg("count").over(before))
    )


def raw_days(raw: DataFrame) -> DataFrame:
    """Volume, rolling mean and null shares per day in one pass over the raw events."""
    raw = fold_aliases(raw)
    nothing = F.lit(None).cast("double")
    null_ids = fields.null_share(F.col("client_id")) if "client_id" in raw.columns else nothing
    no_referrer = (
        fields.null_share(fields.blank_to_null(F.col("referrer"))) if "referrer" in raw.columns else nothing
    )
    before = Window.orderBy("event_date").rowsBetween(-VOLUME_DAYS, -1)
    return (
        raw.groupBy(F.to_date(fields.instant(raw, "timestamp")).alias("event_date"))
        .agg(F.count(F.lit(1)).alias("count"), null_ids.alias("null_ids"), no_referrer.alias("no_referrer"))
        .where(F.col("event_date").isNotNull())
        .withColumn("rolling_avg", F.avg("count").over(before))
    )


def gold_days(gold: DataFrame) -> DataFrame:
    """Total, paid and unattributed revenue per conversion day."""
    revenue = F.col("revenue")
    channel = F.col("last_click_channel")
    return gold.groupBy(F.to_date(fields.instant(gold, "conversion_time")).alias("event_date")).agg(
        fields.money_total(revenue).alias("total_revenue"),
        fields.money_total(F.when(is_paid(channel), revenue)).alias("paid_revenue"),
        fields.money_total(F.when(channel == UNATTRIBUTED, revenue)).alias("unattributed_revenue"),
    )


def dates_to_check(raw: DataFrame, gold: DataFrame, check_date: date | str | None = None) -> DataFrame:
    """One row, the date to check: the given one, else the latest gold date, else today."""
    session = raw.sparkSession
    if check_date is not None:
        return session.range(1).select(F.lit(str(check_date)).cast("date").alias("check_date"))
    if "conversion_time" in gold.columns:
        latest = F.max(F.to_date(fields.instant(gold, "conversion_time")))
        return gold.agg(F.coalesce(latest, F.current_date()).alias("check_date"))
    return session.range(1).select(F.current_date().alias("check_date"))


def _alert(severity: str, code: str, message: Column | str, **details: Column) -> Column:
    pairs = [x for name, value in details.items() for x in (F.lit(name), value.cast("double"))]
    return F.struct(
        F.lit(severity).alias("severity"),
        F.lit(code).alias("code"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,double>").alias("details"),
    )


# The codes and message texts of the alerts below.
def _schema_alerts(raw: DataFrame, gold: DataFrame) -> list[Column]:
    raw = fold_aliases(raw)
    lost = [_alert("P0", "MISSING_RAW_COL", f"Missing Raw Column: {c}") for c in RAW_COLUMNS if c not in raw.columns]
    return lost + [
        _alert("P0", "MISSING_GOLD_COL", f"Missing Gold Column: {c}") for c in GOLD_COLUMNS if c not in gold.columns
    ]


def _volume_alerts() -> list[Column]:
    count, mean = F.col("count"), F.col("rolling_avg")
    off = (count < mean * (1 - VOLUME_DEVIATION)) | (count > mean * (1 + VOLUME_DEVIATION))
    text = F.format_string("Row volume (%d) deviated >50%% from 7-day avg (%d)", count, mean.cast("bigint"))
    empty = F.format_string("No raw rows found for date %s", F.col("check_date").cast("string"))
    return [
        F.when(count.isNull(), _alert("P0", "NO_DATA", empty)),
        F.when((mean > 0) & off, _alert("P0", "VOLUME_ANOMALY", text, count=count, avg=mean.cast("bigint"))),
    ]


def _quality_alerts() -> list[Column]:
    null_ids, no_referrer = F.col("null_ids"), F.col("no_referrer")
    return [
        F.when(
            null_ids > NULL_ID_LIMIT,
            _alert("P1", "GHOST_USERS",
                   F.concat(F.lit("Null Client ID Rate: "), fields.percent_text(null_ids)), rate=null_ids),
        ),
        F.when(
            no_referrer > NO_REFERRER_LIMIT,
            _alert("P0", "REFERRER_BLACKOUT",
                   F.concat(F.lit("Missing Referrer Rate: "), fields.percent_text(no_referrer)), rate=no_referrer),
        ),
    ]


def _business_alerts() -> list[Column]:
    total = F.coalesce("total_revenue", F.lit(0.0))
    paid = F.coalesce("paid_revenue", F.lit(0.0))
    share = F.try_divide(F.col("unattributed_revenue"), total)
    zero = F.format_string("Total Revenue is $0.00 for %s", F.col("check_date").cast("string"))
    blind = F.concat(F.lit("Total Rev is $"), F.format_number(total, 0), F.lit(" but Paid Channel Rev is $0. Check UTM parsing."))
    return [
        F.when(total == 0, _alert("P0", "ZERO_REVENUE", zero)),
        F.when(
            (total > PAID_REVENUE_FLOOR) & (paid == 0),
            _alert("P0", "PAID_BLINDNESS", blind, total_rev=total, paid_rev=paid),
        ),
        F.when(
            share > UNATTRIBUTED_LIMIT,
            _alert("P1", "HIGH_UNATTRIBUTED",
                   F.concat(F.lit("Unattributed Share is "), fields.percent_text(share)), share=share),
        ),
    ]


def every_day(days: DataFrame) -> DataFrame:
    """One row for each day from the first to the last; days that are in no table have NULL everywhere else.

    The window is unpartitioned, but over one row per day.
    """
    until = F.coalesce(F.date_sub(F.lead("check_date").over(Window.orderBy("check_date")), 1), "check_date")
    filled = days.withColumn("until", until).withColumn("day", F.explode(F.sequence("check_date", "until")))
    own = F.col("day") == F.col("check_date")
    return filled.select(F.col("day").alias("check_date"), *[F.when(own, F.col(c)).alias(c) for c in days.columns if c != "check_date"])


def checked_days(raw: DataFrame, gold: DataFrame, check_date: date | str | None = None) -> DataFrame:
    """(check_date, alerts): every checked date with its alerts, schema checks first.

    One aggregate per table and a join of one row per day each, so checking every date
    costs the same two scans as checking one; a given date leaves out what it does not need.
    """
    alerts = _schema_alerts(raw, gold)
    tables = []
    if check_date not in (None, ALL_DATES):
        # Later days change nothing for a given one, and of gold only the day itself counts.
        day = F.lit(str(check_date)).cast("date")
        if "timestamp" in raw.columns:
            raw = raw.where(F.to_date(fields.instant(raw, "timestamp")) <= day)
        if "conversion_time" in gold.columns:
            gold = gold.where(F.to_date(fields.instant(gold, "conversion_time")) == day)
    if "timestamp" in raw.columns:
        tables.append(raw_days(raw))
        alerts = alerts + _volume_alerts() + _quality_alerts()
    if {"conversion_time", "revenue", "last_click_channel"} <= set(gold.columns):
        tables.append(gold_days(gold))
        alerts = alerts + _business_alerts()
    tables = [t.withColumnRenamed("event_date", "check_date") for t in tables]
    if check_date == ALL_DATES and tables:
        days = every_day(reduce(lambda a, b: a.join(b, "check_date", "full"), tables).where(F.col("check_date").isNotNull()))
    else:
        days = reduce(lambda a, b: a.join(b, "check_date", "left"), tables, dates_to_check(raw, gold, check_date))
    kept = F.filter(F.array(*alerts), lambda a: a.isNotNull()) if alerts else F.array()
    return days.select("check_date", kept.alias("alerts"))


def alert_rows(checked: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """(timestamp, check_date, severity, code, message, details), one row per alert."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return checked.select("check_date", F.explode("alerts").alias("a")).select(
        now.alias("timestamp"), "check_date", "a.severity", "a.code", "a.message", "a.details"
    )


def status_rows(checked: DataFrame) -> DataFrame:
    """(check_date, status, alerts): RED on any P0, else YELLOW on any P1, else GREEN."""

    def any_of(severity: str) -> Column:
        return F.exists("alerts", lambda a: a["severity"] == severity)

    status = F.when(any_of("P0"), STATUSES[2]).when(any_of("P1"), STATUSES[1]).otherwise(STATUSES[0])
    return checked.select("check_date", status.alias("status"), F.size("alerts").alias("alerts"))


def monitor(
    raw: DataFrame, gold: DataFrame, check_date: date | str | None = None, as_of: datetime | str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Status rows, alert rows and volume statistics."""
    checked = checked_days(raw, gold, check_date)
    return status_rows(checked), alert_rows(checked, as_of), volume_stats(raw)
