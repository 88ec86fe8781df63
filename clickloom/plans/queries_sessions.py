"""Queries for windows, sessions, conversions, attribution and the rule variants."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.config import PANDAS, SQL
from clickloom.operators import conversions, duplicates, metrics, normalize, quality, sessions
from clickloom.operators.attribution import attribute, attribute_events, match_sessions
from clickloom.operators.monitor import gold_days, volume_stats
from clickloom.plans.comparison_sql import BUYS, credited, facts, first_nonzero, json_text, numbered
from clickloom.plans.registry import query

GOLD = "transaction_id, user_id, revenue, conversion_time, first_click_channel, last_click_channel"
FACTS = """session_id, user_id, session_seq, session_start_ts, session_end_ts, events,
  session_first_channel, session_last_channel, session_campaign"""

# ---------------------------------------------------------------------------- windows


@query("w1_previous_event", "SELECT event_key AS event_id, user_id, prev_ts FROM numbered")
def _(x):
    return sessions.flag_session_starts(x.staged()).select(F.col("event_key").alias("event_id"), "user_id", "prev_ts")


@query("w2_new_session_flag", """
SELECT user_id, event_ts, max(opens) = 1 AS opens FROM numbered GROUP BY 1, 2""")
def _(x):
    flagged = sessions.flag_session_starts(x.staged())
    return flagged.groupBy("user_id", "event_ts").agg(F.bool_or("is_new_session").alias("opens"))


@query("w3_new_session_flag_strict", """
SELECT user_id, event_ts, max(opens) = 1 AS opens FROM numbered_b GROUP BY 1, 2""")
def _(x):
    flagged = sessions.flag_session_starts(x.staged(PANDAS), PANDAS)
    return flagged.groupBy("user_id", "event_ts").agg(F.bool_or("is_new_session").alias("opens"))


@query("w4_session_number", "SELECT event_key AS event_id, user_id, session_seq FROM numbered")
def _(x):
    return sessions.flag_session_starts(x.staged()).select(F.col("event_key").alias("event_id"), "user_id", "session_seq")


@query("w5_rolling_mean", """
SELECT event_date, n AS "count", avg(n) OVER (ORDER BY event_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_avg
FROM (SELECT event_date, count(*) AS n FROM raw GROUP BY 1)""")
def _(x):
    return volume_stats(x.raw)


@query("w6_day_over_day", f"""
SELECT event_date, (n - p) / p AS vol_dod_pct, (r - q) / q AS revenue_dod_pct FROM (
  SELECT *, lag(n) OVER (ORDER BY event_date) AS p, lag(r) OVER (ORDER BY event_date) AS q FROM (
    SELECT event_date, CAST(count(*) AS DOUBLE) AS n,
      CAST(sum(CAST({first_nonzero("value", "revenue", "total")} AS DECIMAL(18, 2))) FILTER (WHERE {BUYS}) AS DOUBLE) AS r
    FROM raw GROUP BY 1))""")
def _(x):
    daily = quality.file_profile(x.raw, "event_date")
    return quality.with_day_over_day(daily).select(F.col("file").alias("event_date"), "vol_dod_pct", "revenue_dod_pct")


@query("w7_ordered_pick", """
SELECT user_id, first(page_url ORDER BY event_ts, event_key) AS landing, last(page_url ORDER BY event_ts, event_key) AS leaving
FROM staged GROUP BY 1""")
def _(x):
    order = F.struct("event_ts", "event_key")
    return x.staged().groupBy("user_id").agg(
        F.min_by("page_url", order).alias("landing"), F.max_by("page_url", order).alias("leaving")
    )


@query("w8_keep_first", "SELECT transaction_id, user_id, conversion_ts, revenue FROM conv_b")
def _(x):
    return conversions.earliest_per_transaction(x.staged(PANDAS), PANDAS)


# --------------------------------------------------------------------------- sessions


@query("a1_session_facts", "SELECT session_id, user_id, session_start_ts, session_end_ts, events FROM ses")
def _(x):
    return x.sessions().select("session_id", "user_id", "session_start_ts", "session_end_ts", "events")


@query("a2_session_channels", "SELECT session_id, session_first_channel, session_last_channel FROM ses")
def _(x):
    return x.sessions().select("session_id", "session_first_channel", "session_last_channel")


@query("a3_session_campaign", "SELECT session_id, session_campaign FROM ses")
def _(x):
    return x.sessions().select("session_id", "session_campaign")


@query("a4_session_facts_b", """
SELECT session_id, user_id AS client_id, session_start_ts AS session_start, session_end_ts AS session_end, events,
  session_first_channel AS channel FROM ses_b""")
def _(x):
    return x.sessions(PANDAS).select(
        "session_id", F.col("user_id").alias("client_id"), F.col("session_start_ts").alias("session_start"),
        F.col("session_end_ts").alias("session_end"), "events", F.col("session_first_channel").alias("channel"),
    )


@query("a1_session_events", """
SELECT user_id || '-S' || CAST(session_seq AS VARCHAR) AS session_id, user_id, event_ts, event_name, page_url, derived_channel,
  utm_source, utm_medium, utm_campaign, revenue, transaction_id FROM numbered""")
def _(x):
    return sessions.session_events(x.staged()).drop("event_key")


# ------------------------------------------------------------------------ aggregations


@query("a5_conversion_dedupe", "SELECT transaction_id, user_id, conversion_ts, revenue FROM conv")
def _(x):
    return conversions.latest_per_user(x.staged())


@query("a5_conversion_dedupe_zero", f"""
SELECT transaction_id, user_id, max(event_ts) AS conversion_ts, max(coalesce(revenue, 0)) AS revenue
FROM staged WHERE {BUYS} AND transaction_id IS NOT NULL GROUP BY 1, 2""")
def _(x):
    return conversions.latest_per_user(x.staged(), replace(SQL, null_revenue="zero"))


@query("a6_conversion_dedupe_b", "SELECT transaction_id, user_id, conversion_ts, revenue FROM conv_b")
def _(x):
    return conversions.conversions(x.staged(PANDAS), PANDAS)


@query("a7_distinct_rows", "SELECT DISTINCT event_id, event_date, event_name, page_url, referrer, event_data FROM raw")
def _(x):
    kept = duplicates.distinct_rows(x.raw)
    return kept.select("event_id", "event_date", "event_name", "page_url", "referrer", "event_data")


@query("a8_exact_duplicates", """
SELECT event_date, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT event_date, event_id, count(*) AS n FROM raw GROUP BY ALL) WHERE n > 1 GROUP BY 1""")
def _(x):
    return duplicates.duplicate_rows(x.raw, "event_date", x.raw.columns)


TRANSACTION = f"coalesce(nullif({json_text('transaction_id')}, ''), nullif({json_text('order_id')}, ''))"


@query("a9_duplicate_transactions", f"""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_transaction_rows FROM (
  SELECT {TRANSACTION} AS t, count(*) AS n FROM raw WHERE {BUYS} GROUP BY 1) WHERE t IS NOT NULL AND n > 1""")
def _(x):
    return duplicates.duplicate_transaction_count(x.files, "file")


@query("a10_rows_per_file", "SELECT event_date, count(*) AS n FROM raw GROUP BY 1")
def _(x):
    return quality.file_profile(x.raw, "event_date").select(F.col("file").alias("event_date"), F.col("rows").alias("n"))


@query("a11_null_rate", """
SELECT event_date, avg(CASE WHEN referrer IS NULL THEN 1.0 ELSE 0.0 END) AS rate, count(*) - count(referrer) AS nulls
FROM raw GROUP BY 1""")
def _(x):
    from clickloom.functions.fields import null_share

    return x.raw.groupBy("event_date").agg(
        null_share(F.col("referrer")).alias("rate"), F.count_if(F.col("referrer").isNull()).alias("nulls")
    )


@query("a12_revenue_sum", f"""
SELECT event_date, coalesce(CAST(sum(CAST({first_nonzero("value", "revenue", "total")} AS DECIMAL(18, 2)))
  FILTER (WHERE {BUYS}) AS DOUBLE), 0) AS revenue FROM raw GROUP BY 1""")
def _(x):
    return quality.file_profile(x.raw, "event_date").select(F.col("file").alias("event_date"), "revenue")


@query("a13_purchase_count", f"SELECT event_date, count(*) FILTER (WHERE {BUYS}) AS purchases FROM raw GROUP BY 1")
def _(x):
    return quality.file_profile(x.raw, "event_date").select(F.col("file").alias("event_date"), "purchases")


BREAKDOWN = """'{' || string_agg('"' || event_name || '":' || n, ',' ORDER BY n DESC, event_name) || '}'"""


@query("a14_event_breakdown", f"""
SELECT event_date, {BREAKDOWN} AS event_breakdown
FROM (SELECT event_date, event_name, count(*) AS n FROM raw GROUP BY ALL) GROUP BY 1""")
def _(x):
    return quality.file_profile(x.raw, "event_date").select(F.col("file").alias("event_date"), "event_breakdown")


@query("a15_conditional_counts", """
SELECT event_date, count(*) FILTER (WHERE cid_old IS NOT NULL) AS client_id_rows,
  count(*) FILTER (WHERE cid_new IS NOT NULL) AS alternate_rows, count(*) AS total_events FROM raw GROUP BY 1""")
def _(x):
    return quality.identity_counts(x.raw, F.col("timestamp"))


@query("a16_count_distinct", """
SELECT count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users FROM ses""")
def _(x):
    return x.sessions().agg(F.count_distinct("session_id").alias("sessions"), F.count_distinct("user_id").alias("users"))


@query("a17_max_then_sum", f"""
SELECT CAST(sum(r) AS DOUBLE) AS revenue FROM (
  SELECT transaction_id, max(CAST(coalesce(revenue, 0) AS DECIMAL(18, 2))) AS r FROM staged
  WHERE {BUYS} AND transaction_id IS NOT NULL GROUP BY 1)""")
def _(x):
    return metrics.revenue_inflation(x.staged()).select(F.col("net_revenue").alias("revenue"))


@query("a18_daily_rows", "SELECT event_date, count(*) AS n FROM staged GROUP BY 1")
def _(x):
    return x.staged().where("event_date IS NOT NULL").groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def _money(condition: str = "") -> str:
    return f"coalesce(CAST(sum(CAST(revenue AS DECIMAL(18, 2))) {condition} AS DOUBLE), 0)"


@query("a19_day_revenue", f"SELECT CAST(conversion_time AS DATE) AS event_date, {_money()} AS total_revenue FROM gold GROUP BY 1")
def _(x):
    return gold_days(x.gold()).select("event_date", "total_revenue")


@query("a20_paid_and_unattributed", f"""
SELECT CAST(conversion_time AS DATE) AS event_date,
  {_money("FILTER (WHERE last_click_channel IN ('Paid Search', 'Paid Social'))")} AS paid_revenue,
  {_money("FILTER (WHERE last_click_channel = 'Unattributed')")} AS unattributed_revenue FROM gold_b GROUP BY 1""")
def _(x):
    return gold_days(x.lean_gold).select("event_date", "paid_revenue", "unattributed_revenue")


@query("a21_unattributed_share", f"""
SELECT CAST(conversion_time AS DATE) AS event_date,
  {_money("FILTER (WHERE last_click_channel = 'Unattributed')")} / nullif({_money()}, 0) AS share FROM gold_b GROUP BY 1""")
def _(x):
    days = gold_days(x.lean_gold)
    return days.select("event_date", F.try_divide("unattributed_revenue", "total_revenue").alias("share"))


@query("a22_latest_gold_date", "SELECT CAST(max(conversion_time) AS DATE) AS check_date FROM gold")
def _(x):
    from clickloom.operators.monitor import dates_to_check

    return dates_to_check(x.raw, x.gold())


@query("a23_daily_revenue", f"SELECT CAST(conversion_time AS DATE) AS day, {_money()} AS revenue FROM gold GROUP BY 1")
def _(x):
    from clickloom.operators.dashboards import daily_revenue

    return daily_revenue(x.gold(), days=None)


@query("a24_channel_mix", f"SELECT last_click_channel AS channel, {_money()} AS revenue FROM gold GROUP BY 1")
def _(x):
    from clickloom.operators.dashboards import channel_mix

    return channel_mix(x.gold(), days=None)


@query("a26_bad_row_counts", """
SELECT (SELECT count(*) FROM ses WHERE session_start_ts > session_end_ts) AS bad_sessions,
  (SELECT count(*) FROM staged WHERE user_id IS NULL) AS null_users""")
def _(x):
    bad = x.sessions().agg(F.count_if(F.col("session_start_ts") > F.col("session_end_ts")).alias("n"))
    null = x.staged().agg(F.count_if(F.col("user_id").isNull()).alias("n"))
    both = bad.select(F.lit("bad").alias("k"), "n").union(null.select(F.lit("null").alias("k"), "n"))
    return both.agg(
        F.sum(F.when(F.col("k") == "bad", F.col("n"))).alias("bad_sessions"),
        F.sum(F.when(F.col("k") == "null", F.col("n"))).alias("null_users"),
    )


# ------------------------------------------------------------------- joins, attribution


@query("j1_first_click", "SELECT transaction_id, user_id, first_click_channel FROM gold")
def _(x):
    return x.gold().select("transaction_id", "user_id", "first_click_channel")


@query("j2_last_click", "SELECT transaction_id, user_id, last_click_channel FROM gold")
def _(x):
    return x.gold().select("transaction_id", "user_id", "last_click_channel")


@query("j1_fact_attribution", f"SELECT {GOLD} FROM gold")
def _(x):
    return x.gold()


@query("j1_matched_session_starts", """
SELECT transaction_id, user_id, first_start, last_start FROM gold""")
def _(x):
    matched = match_sessions(conversions.conversions(x.staged()), x.sessions())
    return matched.select(
        "transaction_id", "user_id",
        F.col("first_touch.start").alias("first_start"), F.col("last_touch.start").alias("last_start"),
    )


@query("j3_fact_attribution_b", """
SELECT transaction_id, revenue, first_click_channel AS first_click, last_click_channel AS last_click FROM gold_b""")
def _(x):
    return x.lean_gold.select(
        "transaction_id", "revenue",
        F.col("first_click_channel").alias("first_click"), F.col("last_click_channel").alias("last_click"),
    )


@query("j4_scalar_subqueries", f"""
SELECT (SELECT count(*) FROM ses) AS sessions, (SELECT min(session_start_ts) FROM ses) AS first_start,
  (SELECT count(DISTINCT transaction_id) FROM staged WHERE {BUYS}) AS transactions""")
def _(x):
    x.sessions().createOrReplaceTempView("scalar_sessions")
    x.staged().where(normalize.is_conversion()).createOrReplaceTempView("scalar_purchases")
    return x.spark.sql("""
        SELECT count(*) AS sessions, min(session_start_ts) AS first_start,
          (SELECT count(DISTINCT transaction_id) FROM scalar_purchases) AS transactions
        FROM scalar_sessions""")


@query("j5_duplicated_transactions", f"""
SELECT t AS "transaction", event_date, count(*) AS occurrences FROM (
  SELECT *, count(*) OVER (PARTITION BY t) AS n FROM (
    SELECT {TRANSACTION} AS t, event_date FROM raw WHERE {BUYS}) WHERE t IS NOT NULL)
WHERE n > 1 GROUP BY 1, 2""")
def _(x):
    return duplicates.duplicate_transactions(x.raw, "event_date")


# --------------------------------------------------------------- sorts, limits, set ops


@query("o1_sorted_events", "SELECT user_id, event_ts, event_key AS event_id FROM staged ORDER BY 1, 2, 3")
def _(x):
    return x.staged().select("user_id", "event_ts", F.col("event_key").alias("event_id")).orderBy("user_id", "event_ts", "event_id")


@query("o2_ordered_attribution", "SELECT transaction_id, user_id, revenue FROM gold ORDER BY 1, 2")
def _(x):
    return x.gold().select("transaction_id", "user_id", "revenue").orderBy("transaction_id", "user_id")


@query("o3_correlated_top_one", f"SELECT {GOLD} FROM gold WHERE first_click_channel <> last_click_channel")
def _(x):
    return attribute(conversions.conversions(x.staged()), x.sessions()).where("first_click_channel <> last_click_channel")


@query("o4_single_value", "SELECT user_id, min(session_start_ts) AS first_start FROM ses GROUP BY 1")
def _(x):
    return x.sessions().groupBy("user_id").agg(F.min("session_start_ts").alias("first_start"))


@query("o6_first_and_last_of_group", """
SELECT user_id, first(session_id ORDER BY session_start_ts) AS first_session, last(session_id ORDER BY session_start_ts) AS last_session
FROM ses GROUP BY 1""")
def _(x):
    return x.sessions().groupBy("user_id").agg(
        F.min_by("session_id", "session_start_ts").alias("first_session"),
        F.max_by("session_id", "session_start_ts").alias("last_session"),
    )


@query("o7_union_of_checks", """
SELECT 'raw' AS layer, count(*) AS n FROM raw UNION ALL SELECT 'staged', count(*) FROM staged
UNION ALL SELECT 'sessions', count(*) FROM ses UNION ALL SELECT 'gold', count(*) FROM gold""")
def _(x):
    layers = {"raw": x.raw, "staged": x.staged(), "sessions": x.sessions(), "gold": x.gold()}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("layer"), "n") for k, df in layers.items()]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


@query("o8_union_by_name", """
SELECT event_id, cid_old AS client_id, CASE WHEN event_date < DATE '2024-01-11' THEN referrer END AS referrer FROM raw""")
def _(x):
    early = x.raw.where("event_date < DATE '2024-01-11'").select("event_id", "client_id", "referrer")
    late = x.raw.where("event_date >= DATE '2024-01-11'").select("client_id", "event_id")
    return early.unionByName(late, allowMissingColumns=True)


# ---------------------------------------------------------------------------- variants


def variant(name: str, settings, sql: str) -> None:
    """Attribution under one changed parameter, or a preset."""

    @query(name, sql)
    def _(x):
        return attribute_events(x.staged(settings), settings)


def _gold(ses: str = "ses", conv: str = "conv", upper: str = "<=", last: str = "session_last_channel",
          fallback: str = "Direct", extra: str = "") -> str:
    return f"{extra} SELECT {GOLD} FROM ({credited(conv, ses, upper, last, fallback)})"


variant("v2_strict_upper_end", replace(SQL, include_conversion_start=False), _gold(upper="<"))
variant("v3_last_click_from_first", replace(SQL, last_click_from="first"), _gold(last="session_first_channel"))
variant("v4_fallback_unattributed", replace(SQL, include_conversion_start=False, fallback="Unattributed"),
        _gold(upper="<", fallback="Unattributed"))
variant("v10_preset_b", PANDAS, f"SELECT {GOLD} FROM gold_b")
variant("v8_earliest_per_transaction", replace(SQL, conversion_dedupe="earliest"), _gold(conv=f"""(
  SELECT transaction_id, user_id, event_ts AS conversion_ts, revenue FROM staged WHERE {BUYS} AND revenue > 0
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY event_ts, event_key) = 1)"""))


def _numbered_facts(late: str, source: str = "chan", sep: str = "-S", counted: str = "*") -> str:
    return f"SELECT {FACTS} FROM ({facts('(' + numbered(source, late) + ')', sep, counted)})"


@query("v1_boundary_strict", _numbered_facts("event_ts - prev_ts > INTERVAL 30 MINUTE"))
def _(x):
    s = replace(SQL, boundary="gt")
    return x.sessions(s)


@query("v1_timeout_hour", _numbered_facts("event_ts - prev_ts >= INTERVAL 60 MINUTE"))
def _(x):
    return x.sessions(replace(SQL, timeout_minutes=60))


@query("v1_timeout_fifty", _numbered_facts("event_ts - prev_ts >= INTERVAL 50 MINUTE"))
def _(x):
    return x.sessions(replace(SQL, timeout_minutes=50))


@query("v1_short_slices", f"SELECT {FACTS} FROM ses")
def _(x):
    return x.sessions(replace(SQL, slice_seconds=60))


@query("v5_session_id_separator", _numbered_facts("event_ts - prev_ts >= INTERVAL 30 MINUTE", sep="_S"))
def _(x):
    return x.sessions(replace(SQL, id_sep="_S"))


@query("v6_channel_rules_b", "SELECT event_key AS event_id, derived_channel FROM chan_b")
def _(x):
    return x.staged(PANDAS).select(F.col("event_key").alias("event_id"), "derived_channel")


@query("v7_deduped_rows", _numbered_facts("event_ts - prev_ts >= INTERVAL 30 MINUTE", "(SELECT DISTINCT * FROM chan)"))
def _(x):
    return x.sessions(replace(SQL, dedupe_rows=True))


@query("v9_revenue_keys", f"""
SELECT event_id, coalesce({first_nonzero("value", "revenue")}, 0) AS revenue FROM raw
WHERE coalesce(cid_old, cid_new) IS NOT NULL""")
def _(x):
    staged = x.staged(replace(SQL, revenue_keys=("value", "revenue")))
    return staged.select(F.col("event_key").alias("event_id"), "revenue")


@query("v11_critical_null_rate", f"""
SELECT event_date, CASE WHEN rate > 0.2 THEN 'contract' WHEN rate > 0.1 THEN 'report' ELSE 'none' END AS critical_for
FROM (SELECT event_date, avg(CASE WHEN coalesce(cid_old, cid_new) IS NULL THEN 1.0 ELSE 0.0 END) AS rate FROM raw GROUP BY 1)""")
def _(x):
    from clickloom.functions.fields import null_share
    from clickloom.operators import contract

    rate = null_share(F.coalesce("client_id", "clientId"))
    level = F.when(rate > contract.NULL_CRITICAL, "contract").when(rate > quality.NULL_CRITICAL, "report").otherwise("none")
    return x.raw.groupBy("event_date").agg(level.alias("critical_for"))
