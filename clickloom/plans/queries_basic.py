"""Queries for sources, normalisation, channels and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.config import PANDAS
from clickloom.functions import channels, fields
from clickloom.operators import normalize, quality
from clickloom.operators.attribution import attribute_events
from clickloom.operators.sessions import build_sessions
from clickloom.plans.comparison_sql import BUYS, CHANNEL_A, CHANNEL_B, first_nonzero, json_number, json_text
from clickloom.plans.registry import Inputs, query
from clickloom.sources import event_files, quarantine, tables
from clickloom.operators.contract import must_quarantine, tag_rows

# ---------------------------------------------------------------- sources and sinks

CSV_COLUMNS = ("event_id", "timestamp", "event_name", "page_url", "event_data")


def daily_files(x: Inputs, with_empty_days: bool = False) -> str:
    """Write the raw events as daily CSV files with three different headers.

    On request also a day with a header alone, without referrer, and one of zero bytes.
    """
    root = tables.shared_folder(x.spark, "daily-files")
    text = x.files.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    old, blind = F.col("event_date") < "2024-01-11", F.col("event_date") == "2024-01-20"
    shapes = [
        (old, ("client_id", *CSV_COLUMNS, "referrer")),
        (~old & ~blind, ("referrer", *CSV_COLUMNS, "clientId")),
        (~old & blind, (*CSV_COLUMNS, "clientId")),
    ]
    for days, columns in shapes:
        event_files.write_event_files(text.where(days).select("file", *columns), root)
    if with_empty_days:
        header = text.select("client_id", *CSV_COLUMNS).limit(0).coalesce(1)
        header.write.option("header", True).csv(f"{root}/file=events_20240301.csv")
        path = x.spark._jvm.org.apache.hadoop.fs.Path(f"{root}/file=events_20240302.csv")
        path.getFileSystem(x.spark._jsc.hadoopConfiguration()).create(path).close()
    return f"{root}/*{event_files.FILE_GLOB}"


FILE_NAME = "'events_' || strftime(event_date, '%Y%m%d') || '.csv'"


@query("s1_find_event_files", f"SELECT DISTINCT {FILE_NAME} AS file FROM raw")
def _(x):
    return event_files.list_files(x.spark, "/nowhere/events_*.csv", daily_files(x)).select("file").distinct()


@query("s2_scan_event_csv", 'SELECT event_id, event_name, page_url, event_data FROM raw')
def _(x):
    read = event_files.read_event_files(x.spark, daily_files(x))
    return read.select(F.col("event_id").cast("bigint").alias("event_id"), "event_name", "page_url", "event_data")


@query("s3_scan_gold_csv", """
SELECT transaction_id, user_id, revenue, conversion_time, first_click_channel, last_click_channel FROM gold""")
def _(x):
    path = tables.shared_folder(x.spark, "gold-csv")
    tables.write_csv(x.gold(), path)
    return tables.read_gold_csv(x.spark, path)


@query("s4_scan_table", "SELECT event_id, ts, value FROM events WHERE event_type = 'purchase'")
def _(x):
    return x.table("events").where("event_type = 'purchase'").select("event_id", "ts", "value")


@query("s5_scan_shards", """
SELECT event_id, event_name, event_date FROM raw WHERE event_date >= DATE '2024-01-10' AND event_date < DATE '2024-01-20'""")
def _(x):
    path = tables.shared_folder(x.spark, "shards")
    x.raw.write.partitionBy("event_date").parquet(path)
    return tables.read_table(x.spark, path, "event_date=2024-01-1*").select("event_id", "event_name", "event_date")


@query("s6_union_of_headers", """
SELECT event_id, cid_old AS client_id, cid_new AS alternate, event_name, page_url, nullif(referrer, '') AS referrer, event_data
FROM raw""")
def _(x):
    read = event_files.read_event_files(x.spark, daily_files(x))
    return read.select(
        F.col("event_id").cast("bigint").alias("event_id"), "client_id", F.col("clientId").alias("alternate"),
        "event_name", "page_url", "referrer", "event_data",
    )


def damaged_files(x: Inputs) -> str:
    """Daily files with a header, some of whose lines lost their last two fields."""
    root = tables.shared_folder(x.spark, "damaged-files")
    whole = F.concat_ws(",", F.col("event_id").cast("string"), "event_name", F.lit("/p"), F.col("timestamp").cast("string"))
    cut = F.concat_ws(",", F.col("event_id").cast("string"), "event_name")
    line = F.when(F.col("event_id") % 89 == 7, cut).otherwise(whole)
    # One column named like the header and parted by nothing: its lines are written as they are.
    lines = x.files.select("file", line.alias("event_id,event_name,page_url,timestamp")).hint("rebalance", F.col("file"))
    lines.write.partitionBy("file").option("header", True).option("sep", "\x01").csv(root)
    return f"{root}/*{event_files.FILE_GLOB}"


@query("s7_tolerant_load", f"""
SELECT {FILE_NAME} AS file, count(*) FILTER (WHERE event_id % 89 <> 7) AS kept,
  count(*) FILTER (WHERE event_id % 89 = 7) AS skipped FROM raw GROUP BY 1""")
def _(x):
    events = event_files.read_event_files(x.spark, damaged_files(x))
    kept = event_files.readable(events).groupBy("file").agg(F.count(F.lit(1)).alias("kept"))
    skipped = event_files.unreadable(events).groupBy("file").agg(F.count(F.lit(1)).alias("skipped"))
    return kept.join(skipped, "file", "left").select("file", "kept", F.coalesce("skipped", F.lit(0)).alias("skipped"))


@query("s8_load_error_row", f"""
SELECT {FILE_NAME} AS file, 'ERROR' AS status, CAST(NULL AS DOUBLE) AS revenue, count(*) AS "rows"
FROM raw GROUP BY 1 HAVING bool_or(event_data IS NOT NULL AND NOT json_valid(event_data))""")
def _(x):
    return quality.dq_report(x.files).where("status = 'ERROR'").select("file", "status", "revenue", "rows")


@query("s9_required_files", "SELECT count(*) AS n FROM raw")
def _(x):
    return event_files.read_event_files(x.spark, daily_files(x), required=True).agg(F.count(F.lit(1)).alias("n"))


@query("s10_file_provenance", f"SELECT {FILE_NAME} AS file, count(*) AS n FROM raw GROUP BY 1")
def _(x):
    return event_files.read_event_files(x.spark, daily_files(x)).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


@query("s11_csv_sink", """
SELECT session_id, user_id, events, session_first_channel, session_campaign FROM ses""")
def _(x):
    path = tables.shared_folder(x.spark, "sessions-csv")
    tables.write_csv(x.sessions(), path)
    back = x.spark.read.option("header", True).csv(path)
    return back.select("session_id", "user_id", F.col("events").cast("bigint").alias("events"), "session_first_channel", "session_campaign")


@query("s12_replace_table", """
SELECT user_id, event_ts, event_name, revenue, transaction_id, utm_campaign, event_date FROM staged""")
def _(x):
    path = tables.shared_folder(x.spark, "staged")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    table = tables.replace_table(normalize.staged_table(x.staged()), name, path)
    return table.select("user_id", "event_ts", "event_name", "revenue", "transaction_id", "utm_campaign", "event_date")


# What the contract asks of a payload: an object with the keys its event requires.
KEYS = "coalesce(json_keys(CASE WHEN json_valid(event_data) THEN event_data END), [])"
NO_OBJECT = "(event_data IS NOT NULL AND coalesce(json_type(CASE WHEN json_valid(event_data) THEN event_data END), '') <> 'OBJECT')"
CRITICAL_ROW = f"""{NO_OBJECT}
  OR (event_name = 'checkout_completed'
      AND (NOT list_contains({KEYS}, 'revenue') OR NOT list_contains({KEYS}, 'transaction_id')
        OR TRY_CAST(coalesce({json_text("revenue")}, {json_text("value")}, {json_text("total")}) AS DOUBLE) <= 0))
  OR (event_name = 'product_added_to_cart' AND NOT (list_contains({KEYS}, 'item_id') AND list_contains({KEYS}, 'item_name')))
  OR (event_name = 'checkout_started' AND NOT list_contains({KEYS}, 'step'))"""


@query("s13_zone_routing", f"""
SELECT event_date, zone, count(*) AS n FROM (
  SELECT event_date, CASE WHEN {CRITICAL_ROW} OR row_number() OVER (PARTITION BY event_id) > 1
    THEN 'quarantine' ELSE 'clean' END AS zone FROM raw) GROUP BY ALL""")
def _(x):
    path = tables.shared_folder(x.spark, "zones")
    quarantine.write_zones(quarantine.route(x.raw), path)
    return x.spark.read.parquet(path).groupBy("event_date", "zone").agg(F.sum("rows").alias("n"))


@query("s14_date_partitions", """
SELECT event_name, count(*) AS n FROM staged WHERE event_date = DATE '2024-01-12' GROUP BY 1""")
def _(x):
    path = tables.shared_folder(x.spark, "by-day")
    tables.overwrite_partitions(normalize.staged_table(x.staged()), path)
    day = tables.read_table(x.spark, path).where("event_date = DATE '2024-01-12'")
    return day.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))


@query("s16_contract_rules", f"""
SELECT event_date, count(*) FILTER (WHERE {CRITICAL_ROW}) AS critical, count(*) AS n FROM raw GROUP BY 1""")
def _(x):
    bad = must_quarantine(F.col("findings"))
    return tag_rows(x.raw).groupBy("event_date").agg(F.count_if(bad).alias("critical"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------- normalisation and predicates


@query("p1_identity_coalesce", "SELECT event_id, coalesce(cid_old, cid_new) AS user_id FROM raw")
def _(x):
    return x.raw.select("event_id", F.coalesce("client_id", "clientId").alias("user_id"))


@query("p2_column_drift_rename", "SELECT event_id, cid_new AS client_id FROM raw WHERE event_date >= DATE '2024-01-11'")
def _(x):
    late = x.raw.where("event_date >= DATE '2024-01-11'").drop("client_id")
    return normalize.fold_aliases(late).select("event_id", "client_id")


@query("p3_all_aliases", """
SELECT event_id, coalesce(cid_old, cid_new) AS client_id, page_url, referrer,
  'pageURL,referrer_url' AS drifted FROM raw""")
def _(x):
    renamed = x.raw.withColumnsRenamed({"page_url": "pageURL", "referrer": "referrer_url"})
    drifted = ",".join(normalize.drifted_columns(renamed))
    folded = normalize.fold_aliases(renamed)
    return folded.select("event_id", "client_id", "page_url", "referrer", F.lit(drifted).alias("drifted"))


@query("p4_fill_missing_column", "SELECT event_id, CAST(NULL AS VARCHAR) AS referrer, page_url FROM raw")
def _(x):
    return normalize.fill_missing(x.raw.drop("referrer"), ("referrer", "page_url")).select("event_id", "referrer", "page_url")


@query("p5_drop_null_identity", "SELECT user_id, event_key AS event_id FROM staged")
def _(x):
    return x.staged().select("user_id", F.col("event_key").alias("event_id"))


@query("p6_conversion_filter", f"SELECT event_id, event_name FROM raw WHERE {BUYS}")
def _(x):
    return x.raw.where(normalize.is_conversion()).select("event_id", "event_name")


@query("p7_transaction_present", f"SELECT event_key AS event_id, transaction_id FROM staged WHERE {BUYS} AND transaction_id IS NOT NULL")
def _(x):
    from clickloom.operators.conversions import conversion_events

    return conversion_events(x.staged()).select(F.col("event_key").alias("event_id"), "transaction_id")


@query("p8_positive_revenue", f"SELECT event_key AS event_id, revenue FROM staged_b WHERE {BUYS} AND revenue > 0")
def _(x):
    from clickloom.operators.conversions import conversion_events

    return conversion_events(x.staged(PANDAS), PANDAS).select(F.col("event_key").alias("event_id"), "revenue")


@query("p9_one_day", "SELECT event_key AS event_id, event_name FROM staged WHERE event_date = DATE '2024-01-15'")
def _(x):
    return x.staged().where("event_date = DATE '2024-01-15'").select(F.col("event_key").alias("event_id"), "event_name")


@query("p10_date_range", """
SELECT event_date, count(*) FILTER (WHERE cid_old IS NOT NULL) AS client_id_rows,
  count(*) FILTER (WHERE cid_new IS NOT NULL) AS alternate_rows, count(*) AS total_events
FROM raw WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-18' GROUP BY 1""")
def _(x):
    return quality.identity_counts(x.raw, F.col("timestamp"), "2024-01-05", "2024-01-18")


@query("p11_relative_time", """
SELECT count(*) FILTER (WHERE event_ts >= TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 14 DAY) AS two_weeks,
  count(*) FILTER (WHERE event_ts >= TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 7 DAY) AS one_week,
  count(*) FILTER (WHERE event_ts >= TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 24 HOUR) AS one_day,
  count(*) FILTER (WHERE event_date = DATE '2024-01-28') AS today FROM staged""")
def _(x):
    from clickloom.operators.dashboards import moment_of, since

    now = "2024-01-28 12:00:00"
    return x.staged().agg(
        F.count_if(since("event_ts", now, days=14)).alias("two_weeks"),
        F.count_if(since("event_ts", now, days=7)).alias("one_week"),
        F.count_if(since("event_ts", now, hours=24)).alias("one_day"),
        F.count_if(F.col("event_date") == F.to_date(moment_of(now))).alias("today"),
    )


STAGED = """user_id, event_ts, event_name, page_url, referrer_host, revenue, transaction_id,
  utm_source, utm_medium, utm_campaign, event_date"""


@query("p12_staged_projection", f"SELECT {STAGED} FROM staged")
def _(x):
    return normalize.staged_table(x.staged())


@query("p13_session_id_text", "SELECT session_id, 'ge' AS rule FROM ses UNION ALL SELECT session_id, 'gt' FROM ses_b")
def _(x):
    a = x.sessions().select("session_id", F.lit("ge").alias("rule"))
    return a.union(x.sessions(PANDAS).select("session_id", F.lit("gt").alias("rule")))


@query("p14_column_presence", """
SELECT event_date, count(cid_old) > 0 AS has_client_id, count(cid_new) > 0 AS has_alternate,
  count(referrer) > 0 AS has_referrer FROM raw GROUP BY 1""")
def _(x):
    return (
        quality.file_profile(x.raw, "event_date")
        .select(F.col("file").alias("event_date"), "has_client_id", "has_alternate", "has_referrer")
    )


@query("p15_quarantine_predicate", f"SELECT event_id, event_name FROM raw WHERE {CRITICAL_ROW}")
def _(x):
    return tag_rows(x.raw).where(must_quarantine(F.col("findings"))).select("event_id", "event_name")


# ------------------------------------------------------------------------- channels


@query("c1_channel_rules_a", "SELECT event_key AS event_id, derived_channel AS channel FROM chan")
def _(x):
    return x.staged().select(F.col("event_key").alias("event_id"), F.col("derived_channel").alias("channel"))


@query("c2_channel_rules_b", f"SELECT event_id, {CHANNEL_B} AS channel FROM raw")
def _(x):
    return x.raw.select("event_id", channels.channel_by_text(F.col("page_url"), F.col("referrer")).alias("channel"))


@query("c3_paid_channels", """
SELECT event_key AS event_id, derived_channel IN ('Paid Search', 'Paid Social') AS paid FROM chan""")
def _(x):
    return x.staged().select(F.col("event_key").alias("event_id"), channels.is_paid(F.col("derived_channel")).alias("paid"))


@query("c1_channels_of_pages", f"""
SELECT page_id, {CHANNEL_A} AS channel FROM (
  SELECT page_id, lower(nullif(regexp_extract(url, '[?&]utm_medium=([^&]+)', 1), '')) AS utm_medium,
    lower(nullif(regexp_extract(url, 'https?://([^/]+)', 1), '')) AS referrer_host FROM pages)""")
def _(x):
    url = F.col("url")
    return x.table("pages").select(
        "page_id", channels.channel_by_tags(fields.utm_tag(url, "medium"), fields.url_host(url)).alias("channel")
    )


# ------------------------------------------------------------------ scalar functions


@query("f1_coalesce", "SELECT event_id, coalesce(cid_old, cid_new, 'nobody') AS who, coalesce(referrer, '') AS referrer FROM raw")
def _(x):
    who = F.coalesce("client_id", "clientId", F.lit("nobody"))
    return x.raw.select("event_id", who.alias("who"), F.coalesce("referrer", F.lit("")).alias("referrer"))


@query("f2_url_host", """
SELECT page_id, lower(nullif(regexp_extract(url, 'https?://([^/]+)', 1), '')) AS host FROM pages""")
def _(x):
    return x.table("pages").select("page_id", fields.url_host(F.col("url")).alias("host"))


@query("f3_utm_tags", """
SELECT event_key AS event_id, utm_source, utm_medium, utm_campaign FROM staged""")
def _(x):
    return x.staged().select(F.col("event_key").alias("event_id"), "utm_source", "utm_medium", "utm_campaign")


@query("f3_utm_tags_of_pages", "SELECT page_id, " + ", ".join(
    f"lower(nullif(regexp_extract(url, '[?&]utm_{n}=([^&]+)', 1), '')) AS utm_{n}" for n in ("source", "medium", "campaign"))
    + " FROM pages")
def _(x):
    names = ("source", "medium", "campaign")
    return x.table("pages").select("page_id", *[fields.utm_tag(F.col("url"), n).alias(f"utm_{n}") for n in names])


@query("f4_lower", "SELECT event_id, lower(referrer) AS referrer, lower(page_url) AS page_url FROM raw")
def _(x):
    return x.raw.select("event_id", F.lower("referrer").alias("referrer"), F.lower("page_url").alias("page_url"))


@query("f5_payload_value", f"""
SELECT event_id, {json_text("transaction_id")} AS transaction_id, {json_text("item_id")} AS item_id FROM raw""")
def _(x):
    keys = ("transaction_id", "item_id")
    return x.raw.select("event_id", *[fields.payload_value(F.col("event_data"), k).alias(k) for k in keys])


@query("f6_safe_cast", f"""
SELECT event_id, {json_number("value")} AS revenue, {json_number("transaction_id")} AS id_number FROM raw""")
def _(x):
    value = {k: fields.as_number(fields.payload_value(F.col("event_data"), k)) for k in ("value", "transaction_id")}
    return x.raw.select("event_id", value["value"].alias("revenue"), value["transaction_id"].alias("id_number"))


@query("f7_payload_validity", """
SELECT event_id, event_data IS NOT NULL AND NOT json_valid(event_data) AS broken FROM raw""")
def _(x):
    return x.raw.select("event_id", fields.payload_is_broken(F.col("event_data")).alias("broken"))


@query("f8_tolerant_payload", f"""
SELECT event_id, coalesce({first_nonzero("value", "revenue")}, 0) AS revenue,
  {json_text("transaction_id")} AS transaction_id FROM raw WHERE {BUYS}""")
def _(x):
    payload = F.col("event_data")
    return x.raw.where(normalize.is_conversion()).select(
        "event_id",
        fields.payload_revenue(payload, PANDAS.revenue_keys).alias("revenue"),
        fields.payload_value(payload, "transaction_id").alias("transaction_id"),
    )


@query("f9_first_truthy_of_three", f"""
SELECT event_id, {first_nonzero("value", "revenue", "total")} AS revenue FROM raw""")
def _(x):
    stated = fields.first_truthy(F.col("event_data"), quality.REVENUE_KEYS)
    return x.raw.select("event_id", fields.as_number(stated).alias("revenue"))


@query("f10_first_truthy_of_two", f"""
SELECT event_id, coalesce({first_nonzero("value", "revenue")}, 0) AS revenue FROM raw""")
def _(x):
    return x.raw.select("event_id", fields.payload_revenue(F.col("event_data"), ("value", "revenue")).alias("revenue"))


@query("f11_first_truthy_id", f"""
SELECT event_id, coalesce(nullif({json_text("transaction_id")}, ''), nullif({json_text("order_id")}, '')) AS transaction
FROM raw WHERE {BUYS}""")
def _(x):
    stated = fields.first_truthy(F.col("event_data"), ("transaction_id", "order_id"))
    return x.raw.where(normalize.is_conversion()).select("event_id", stated.alias("transaction"))


def iso_text(x: Inputs) -> DataFrame:
    """Raw events with the timestamp as ISO text; some of it is no timestamp."""
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return x.raw.withColumn("timestamp", F.when(F.col("event_id") % 101 == 3, "soon").otherwise(text))


@query("f12_parse_timestamp", 'SELECT event_id, CASE WHEN event_id % 101 <> 3 THEN "timestamp" END AS event_ts FROM raw')
def _(x):
    events = iso_text(x)
    return events.select("event_id", fields.instant(events, "timestamp").alias("event_ts"))


@query("f13_lenient_date", """
SELECT CASE WHEN event_id % 101 <> 3 THEN event_date END AS day, count(*) AS n FROM raw GROUP BY 1""")
def _(x):
    events = iso_text(x)
    return events.groupBy(F.to_date(fields.instant(events, "timestamp")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("f14_strict_timestamp", 'SELECT event_id, "timestamp" AS event_ts FROM raw')
def _(x):
    events = x.raw.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return events.select("event_id", fields.instant(events, "timestamp", "fail").alias("event_ts"))


@query("f15_day_of_timestamp", 'SELECT event_id, CAST("timestamp" AS DATE) AS day FROM raw')
def _(x):
    return x.raw.select("event_id", F.to_date("timestamp").alias("day"))


@query("f16_whole_minutes", """
SELECT event_key AS event_id, date_sub('minute', prev_ts, event_ts) AS minutes FROM numbered""")
def _(x):
    from clickloom.operators.sessions import flag_session_starts

    gap = fields.whole_minutes_between(F.col("prev_ts"), F.col("event_ts"))
    return flag_session_starts(x.staged()).select(F.col("event_key").alias("event_id"), gap.alias("minutes"))


@query("f17_exact_gap", """
SELECT event_key AS event_id, event_ts - prev_ts > INTERVAL 30 MINUTE AS longer FROM numbered""")
def _(x):
    from clickloom.operators.sessions import flag_session_starts

    longer = F.col("event_ts") > F.col("prev_ts") + F.expr("INTERVAL 30 MINUTES")
    return flag_session_starts(x.staged()).select(F.col("event_key").alias("event_id"), longer.alias("longer"))


@query("f18_lookback_start", 'SELECT event_id, "timestamp" - INTERVAL 7 DAY AS lookback FROM raw')
def _(x):
    return x.raw.select("event_id", fields.days_before(F.col("timestamp"), 7).alias("lookback"))


@query("f19_concat_cast", "SELECT event_id, event_name || '-' || CAST(event_id AS VARCHAR) AS label FROM raw")
def _(x):
    return x.raw.select("event_id", F.concat("event_name", F.lit("-"), F.col("event_id").cast("string")).alias("label"))


@query("f20_substring_and_membership", """
SELECT event_id, referrer LIKE '%t.co%' AS has_marker, event_name IN ('page_viewed', 'checkout_started') AS listed FROM raw""")
def _(x):
    return x.raw.select(
        "event_id",
        F.col("referrer").contains("t.co").alias("has_marker"),
        F.col("event_name").isin("page_viewed", "checkout_started").alias("listed"),
    )


@query("f21_case_when", """
SELECT event_id, CASE WHEN event_data IS NULL THEN 'none' WHEN event_data = '{}' THEN 'empty' ELSE 'filled' END AS kind FROM raw""")
def _(x):
    payload = F.col("event_data")
    kind = F.when(payload.isNull(), "none").when(payload == "{}", "empty").otherwise("filled")
    return x.raw.select("event_id", kind.alias("kind"))


@query("f22_format_text", """
SELECT event_date, printf('rows=%d kept=%s', count(*), CAST(count(cid_old) + count(cid_new) AS VARCHAR)) AS details
FROM raw GROUP BY 1""")
def _(x):
    return x.raw.groupBy("event_date").agg(
        F.format_string(
            "rows=%d kept=%s", F.count(F.lit(1)), F.count(F.coalesce("client_id", "clientId")).cast("string")
        ).alias("details")
    )


@query("f23_round", "SELECT event_id, round(CAST(value AS DECIMAL(12, 2)) / 7, 4) AS share FROM events")
def _(x):
    share = F.round(F.col("value").cast("decimal(12,2)").cast("double") / 7, 4)
    return x.table("events").select("event_id", share.alias("share"))


@query("f24_truncate", "SELECT event_id, CAST(trunc(value) AS BIGINT) AS whole FROM events")
def _(x):
    return x.table("events").select("event_id", F.col("value").cast("bigint").alias("whole"))


@query("f25_blank_to_null", "SELECT event_id, nullif(referrer, '') AS referrer FROM raw")
def _(x):
    return x.raw.select("event_id", fields.blank_to_null(F.col("referrer")).alias("referrer"))


@query("f26_null_tests", "SELECT event_id, referrer IS NULL AS no_referrer, event_data IS NOT NULL AS has_payload FROM raw")
def _(x):
    return x.raw.select(
        "event_id", F.col("referrer").isNull().alias("no_referrer"), F.col("event_data").isNotNull().alias("has_payload")
    )


@query("f27_as_of", """
SELECT event_key AS event_id FROM staged WHERE event_ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR""")
def _(x):
    from clickloom.operators.dashboards import since

    return x.staged().where(since("event_ts", "2024-01-30 00:00:00", hours=24)).select(F.col("event_key").alias("event_id"))


@query("f28_first_element", """
SELECT user_id, first(derived_channel ORDER BY event_ts, event_key) AS first_channel FROM chan GROUP BY 1""")
def _(x):
    return x.staged().groupBy("user_id").agg(
        F.min_by("derived_channel", F.struct("event_ts", "event_key")).alias("first_channel")
    )


@query("f29_json_text", """
SELECT event_date, '{"rows":' || count(*) || ',"purchases":' || count(*) FILTER (WHERE event_name = 'checkout_completed') || '}' AS doc
FROM raw GROUP BY 1""")
def _(x):
    return x.raw.groupBy("event_date").agg(
        F.to_json(F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(normalize.is_conversion()).alias("purchases"))).alias("doc")
    )


@query("f30_severity_fold", """
SELECT event_date, CASE WHEN bool_or(cid_old IS NULL AND cid_new IS NULL AND event_name = 'checkout_completed') THEN 'RED'
  WHEN bool_or(cid_old IS NULL AND cid_new IS NULL) THEN 'YELLOW' ELSE 'GREEN' END AS status FROM raw GROUP BY 1""")
def _(x):
    lost = F.col("client_id").isNull() & F.col("clientId").isNull()
    rank = F.when(lost & normalize.is_conversion(), 2).when(lost, 1).otherwise(0)
    names = F.array(F.lit("GREEN"), F.lit("YELLOW"), F.lit("RED"))
    return x.raw.groupBy("event_date").agg((F.max(rank) + 1).alias("worst")).select(
        "event_date", F.element_at(names, F.col("worst")).alias("status")
    )
