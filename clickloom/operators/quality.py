"""Quality report: one row per daily file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import fields
from clickloom.operators.duplicates import duplicate_rows
from clickloom.operators.normalize import is_conversion

# Thresholds, revenue keys in order of preference, and alert texts.
NULL_WARNING = 0.05
NULL_CRITICAL = 0.1
REVENUE_KEYS = ("value", "revenue", "total")
DRIFT_ALERT = "SCHEMA_DRIFT: clientId -> client_id"
REFERRER_ALERT = "MISSING_COL: referrer"
NULLS_ALERT = "HIGH_NULLS: "

REPORT_COLUMNS = (
    "file", "status", "alerts", "rows", "null_rate", "duplicate_rows", "revenue", "purchases",
    "event_breakdown", "revenue_dod_pct", "vol_dod_pct",
)

STATUS_ORDER = ("PASS", "WARNING", "CRITICAL")


def _in_file(events: DataFrame, column: str) -> Column:
    """Whether the file has the column, as an aggregate.

    Files read with their header know; a table does not, so there a column with no value
    on a whole day counts as absent.
    """
    if column not in events.columns:
        return F.lit(False)
    if "header" in events.columns:
        return F.coalesce(F.max(F.array_contains("header", column)), F.lit(False))
    return F.count(column) > 0


def file_profile(events: DataFrame, file: str = "file") -> DataFrame:
    """Counts per file that every check builds on, in one pass over the events.

    Events are counted per (file, event name) first, so the second grouping, which also
    gives the breakdown, sees a few rows per file whatever the size of the file.
    """
    events, parsed = fields.with_parsed(events)
    stated = fields.first_truthy_of(F.col(parsed), REVENUE_KEYS)
    revenue = fields.as_number(stated)
    broken = (F.col("event_data").isNotNull() & F.col(parsed).isNull()) | (is_conversion() & stated.isNotNull() & revenue.isNull())
    if "_corrupt_record" in events.columns:
        corrupt = F.col("_corrupt_record").isNotNull()
    else:
        corrupt = F.lit(False)

    def missing(column: str) -> Column:
        return F.count_if(F.col(column).isNull()) if column in events.columns else F.lit(None).cast("bigint")

    per_name = events.groupBy(F.col(file).alias("file"), "event_name").agg(
        F.count(F.lit(1)).alias("n"),
        _in_file(events, "client_id").alias("has_client_id"),
        _in_file(events, "clientId").alias("has_alternate"),
        _in_file(events, "referrer").alias("has_referrer"),
        missing("client_id").alias("null_client_id"),
        missing("clientId").alias("null_alternate"),
        F.count_if(broken).alias("broken_payloads"),
        F.count_if(corrupt).alias("corrupt_rows"),
        F.count_if(is_conversion()).alias("purchases"),
        F.sum(F.when(is_conversion(), fields.money(revenue))).alias("revenue"),
    )
    counted = F.collect_list(
        F.when(F.col("event_name").isNotNull(), F.struct((-F.col("n")).alias("order"), "event_name", "n"))
    )
    return per_name.groupBy("file").agg(
        F.sum("n").alias("rows"),
        F.max("has_client_id").alias("has_client_id"),
        F.max("has_alternate").alias("has_alternate"),
        F.max("has_referrer").alias("has_referrer"),
        F.sum("null_client_id").alias("null_client_id"),
        F.sum("null_alternate").alias("null_alternate"),
        F.sum("broken_payloads").alias("broken_payloads"),
        F.sum("corrupt_rows").alias("corrupt_rows"),
        F.sum("purchases").alias("purchases"),
        F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
        F.to_json(
            F.map_from_entries(F.transform(F.sort_array(counted), lambda e: F.struct(e["event_name"], e["n"])))
        ).alias("event_breakdown"),
    )


def with_day_over_day(report: DataFrame, order: str = "file") -> DataFrame:
    """Relative change of revenue and rows against the file before.

    The window is unpartitioned, but over one row per daily file.
    """
    by_file = Window.orderBy(order)
    return report.withColumns(
        {
            "revenue_dod_pct": fields.change_from_previous(F.col("revenue"), by_file),
            "vol_dod_pct": fields.change_from_previous(F.col("rows"), by_file),
        }
    )


def file_status(
    drift: Column, no_referrer: Column, null_rate: Column, rule: str = "reference", critical: float = NULL_CRITICAL
) -> Column:
    """PASS, WARNING or CRITICAL.

    Under 'reference' the null-rate check, when it fires, overwrites the earlier ones;
    under 'max' the worst one stands.
    """
    by_nulls = F.when(null_rate > critical, 2).when(null_rate > NULL_WARNING, 1)
    by_columns = F.when(no_referrer, 2).when(drift, 1).otherwise(0)
    if rule == "reference":
        rank = F.coalesce(by_nulls, by_columns)
    elif rule == "max":
        rank = F.greatest(by_nulls, by_columns)
    else:
        raise ValueError(f"unknown status rule {rule!r}")
    return F.element_at(F.array(*[F.lit(s) for s in STATUS_ORDER]), rank + 1)


def file_alerts(drift: Column, no_referrer: Column, null_rate: Column) -> Column:
    texts = F.array(
        F.when(drift, DRIFT_ALERT),
        F.when(no_referrer, REFERRER_ALERT),
        F.when(null_rate > NULL_WARNING, F.concat(F.lit(NULLS_ALERT), fields.percent_text(null_rate))),
    )
    return F.filter(texts, lambda text: text.isNotNull())


def with_days_without_events(profile: DataFrame, delivered: DataFrame) -> DataFrame:
    """The profile with a row for every delivered file; ``blank`` marks those without a header.  One row per file each."""
    listed = delivered.select("file", F.col("header").alias("listed"))
    zero = [c for c in profile.columns if c not in ("file", "event_breakdown") and not c.startswith("has_")]
    found = {
        f"has_{name}": F.coalesce(f"has_{name}", F.array_contains("listed", column), F.lit(False))
        for name, column in (("client_id", "client_id"), ("alternate", "clientId"), ("referrer", "referrer"))
    }
    return (
        profile.join(listed, "file", "full")
        .withColumn("blank", F.col("rows").isNull() & F.col("listed").isNull())
        .withColumns(found | {"event_breakdown": F.coalesce("event_breakdown", F.lit("{}"))})
        .fillna(0, zero)
        .drop("listed")
    )


def dq_report(
    events: DataFrame,
    file: str = "file",
    status_rule: str = "reference",
    critical_null_rate: float = NULL_CRITICAL,
    delivered: DataFrame | None = None,
) -> DataFrame:
    """The report, one row per file, on raw events (original column names kept).

    ``delivered`` lists (file, bytes, header) of all daily files: one with a header alone is
    a row of 0 events judged by its header, one without any is an ERROR row.
    """
    plain = [c for c in events.columns if c not in ("header", "_corrupt_record", file)]
    copies = duplicate_rows(events.withColumnRenamed(file, "file"), "file", plain)
    profile = file_profile(events, file)
    profile = profile.withColumn("blank", F.lit(False)) if delivered is None else with_days_without_events(profile, delivered)
    drift = F.col("has_alternate") & ~F.col("has_client_id")
    nulls = F.when(drift, F.col("null_alternate")).otherwise(F.col("null_client_id"))
    known = profile.select(
        "*",
        drift.alias("drift"),
        (~F.col("has_referrer")).alias("no_referrer"),
        F.when(drift | F.col("has_client_id"), F.try_divide(nulls, F.col("rows"))).alias("null_rate"),
        (F.col("blank") | (F.col("corrupt_rows") > 0)).alias("unreadable"),
        (F.col("blank") | (F.col("corrupt_rows") > 0) | (F.col("broken_payloads") > 0)).alias("failed"),
    ).join(copies, "file", "left")
    readable = ~F.col("unreadable")
    complete = ~F.col("failed")
    checks = (F.col("drift"), F.col("no_referrer"), F.col("null_rate"))
    failure = F.when(F.col("blank"), "READ_ERROR: no columns").when(
        F.col("unreadable"), F.format_string("READ_ERROR: %d unreadable rows", F.col("corrupt_rows"))
    ).otherwise(F.format_string("PARSE_ERROR: %d unparseable payloads", F.col("broken_payloads")))
    found = F.when(readable, file_alerts(*checks)).otherwise(F.array().cast("array<string>"))
    report = known.select(
        "file",
        F.when(F.col("failed"), "ERROR").otherwise(file_status(*checks, status_rule, critical_null_rate)).alias("status"),
        F.when(F.col("failed"), F.concat(found, F.array(failure))).otherwise(found).alias("alerts"),
        F.when(readable, F.col("rows")).alias("rows"),
        F.when(readable, F.col("null_rate")).alias("null_rate"),
        F.when(readable, F.coalesce("duplicate_rows", F.lit(0))).alias("duplicate_rows"),
        F.when(complete, F.col("revenue")).alias("revenue"),
        F.when(complete, F.col("purchases")).alias("purchases"),
        F.when(complete, F.col("event_breakdown")).alias("event_breakdown"),
    )
    return with_day_over_day(report).select(*REPORT_COLUMNS)


def identity_counts(events: DataFrame, moment: Column, start=None, end=None) -> DataFrame:
    """Rows per day by the raw identity column that holds a value."""
    if start is not None:
        events = events.where(moment.between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return events.groupBy(F.to_date(moment).alias("event_date")).agg(
        F.count_if(F.col("client_id").isNotNull()).alias("client_id_rows"),
        F.count_if(F.col("clientId").isNotNull()).alias("alternate_rows"),
        F.count(F.lit(1)).alias("total_events"),
    )
