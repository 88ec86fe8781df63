"""Queries for the quality report, the contract, the monitor, checks, dashboards and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.config import PANDAS
from clickloom.operators import checks, contract, dashboards, metrics, monitor, quality
from clickloom.operators.attribution import match_sessions
from clickloom.operators.conversions import conversions
from clickloom.plans.comparison_sql import BUYS, first_nonzero, json_text
from clickloom.plans.queries_basic import FILE_NAME, KEYS, NO_OBJECT, daily_files
from clickloom.plans.queries_sessions import BREAKDOWN, TRANSACTION
from clickloom.plans.registry import Inputs, query
from clickloom.sources import event_files

# ---------------------------------------------------------------------- quality report


def report_sql(source: str, status: str = "coalesce(by_nulls, by_columns)") -> str:
    """The report; ``status`` combines the ranks of the null-rate and the column checks."""
    return f"""
    SELECT file, CASE WHEN broken > 0 THEN 'ERROR' ELSE list_extract(['PASS', 'WARNING', 'CRITICAL'], {status} + 1) END AS status,
      concat_ws('; ', CASE WHEN drift THEN 'SCHEMA_DRIFT: clientId -> client_id' END,
        CASE WHEN no_referrer THEN 'MISSING_COL: referrer' END,
        CASE WHEN null_rate > 0.05 THEN 'HIGH_NULLS: ' || printf('%.1f%%', null_rate * 100) END,
        CASE WHEN broken > 0 THEN 'PARSE_ERROR: ' || broken || ' unparseable payloads' END) AS alerts,
      "rows", null_rate, duplicate_rows, CASE WHEN broken = 0 THEN revenue END AS revenue,
      CASE WHEN broken = 0 THEN purchases END AS purchases, CASE WHEN broken = 0 THEN event_breakdown END AS event_breakdown
    FROM (
      SELECT *, CASE WHEN null_rate > 0.1 THEN 2 WHEN null_rate > 0.05 THEN 1 END AS by_nulls,
        CASE WHEN no_referrer THEN 2 WHEN drift THEN 1 ELSE 0 END AS by_columns
      FROM (
        SELECT file, event_date, count(*) AS "rows", count(cid_old) = 0 AND count(cid_new) > 0 AS drift,
          count(referrer) = 0 AS no_referrer,
          (count(*) - CASE WHEN count(cid_old) = 0 THEN count(cid_new) ELSE count(cid_old) END) / count(*) AS null_rate,
          count(*) - count(DISTINCT event_id) AS duplicate_rows,
          count(*) FILTER (WHERE event_data IS NOT NULL AND NOT json_valid(event_data)) AS broken,
          coalesce(CAST(sum(CAST({first_nonzero("value", "revenue", "total")} AS DECIMAL(18, 2))) FILTER (WHERE {BUYS}) AS DOUBLE), 0) AS revenue,
          count(*) FILTER (WHERE {BUYS}) AS purchases
        FROM (SELECT *, {FILE_NAME} AS file FROM {source}) GROUP BY ALL)
      JOIN (SELECT event_date, {BREAKDOWN} AS event_breakdown
            FROM (SELECT event_date, event_name, count(*) AS n FROM {source} GROUP BY ALL) GROUP BY 1) USING (event_date))
    """


def with_changes(report: str) -> str:
    def change(column: str) -> str:
        return f"""(last_value({column} IGNORE NULLS) OVER (ORDER BY file ROWS UNBOUNDED PRECEDING)
          - last_value({column} IGNORE NULLS) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
          / nullif(CAST(last_value({column} IGNORE NULLS) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0)"""

    return f"""SELECT *, {change("revenue")} AS revenue_dod_pct, {change('"rows"')} AS vol_dod_pct FROM ({report})"""


@query("q7_dq_report_with_errors", with_changes(report_sql("raw")))
def _(x):
    return quality.dq_report(x.files)


@query("q8_dq_report", with_changes(report_sql("mended")))
def _(x):
    return quality.dq_report(x.mended_files)


@query("q3_dq_report_worst_status", f"SELECT file, status FROM ({report_sql('mended', 'greatest(by_nulls, by_columns)')})")
def _(x):
    return quality.dq_report(x.mended_files, status_rule="max").select("file", "status")


@query("q7_report_of_delivered_files", f"""
SELECT file, status, "rows" FROM ({report_sql("raw")}) UNION ALL
SELECT * FROM (VALUES ('events_20240301.csv', 'CRITICAL', 0), ('events_20240302.csv', 'ERROR', NULL)) v""")
def _(x):
    found = daily_files(x, with_empty_days=True)
    events = event_files.read_event_files(x.spark, found)
    return quality.dq_report(events, delivered=event_files.delivered_files(x.spark, found)).select("file", "status", "rows")


def _part(name: str, *columns: str) -> None:
    quoted = ", ".join(f'"{c}"' for c in columns)

    @query(name, f"SELECT file, {quoted} FROM ({report_sql('mended')})")
    def _(x: Inputs):
        return quality.dq_report(x.mended_files).select("file", *columns)


_part("q1_schema_drift", "alerts")
_part("q2_missing_referrer", "status", "alerts")
_part("q3_null_identity", "status", "null_rate")
_part("q4_duplicate_rows", "duplicate_rows")
_part("q5_revenue_purchases", "revenue", "purchases")
_part("q6_event_breakdown", "event_breakdown")


@query("q9_cross_file_transactions", f"""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_transaction_rows FROM (
  SELECT {TRANSACTION} AS t, count(*) AS n FROM mended WHERE {BUYS} GROUP BY 1) WHERE t IS NOT NULL AND n > 1""")
def _(x):
    from clickloom.operators.duplicates import duplicate_transaction_count

    return duplicate_transaction_count(x.mended_files, "file")


# ---------------------------------------------------------------------------- contract

FINDING = "rule, severity, code, event_date, key, n"


def finding(rule: str, severity: str, code: str, key: str, n: str, source: str) -> str:
    return f"""SELECT '{rule}' AS rule, {severity} AS severity, '{code}' AS code, event_date, {key} AS key,
      CAST({n} AS BIGINT) AS n {source}"""


REQUIRED = """CASE event_name WHEN 'checkout_completed' THEN ['transaction_id', 'revenue'] WHEN 'purchase' THEN ['transaction_id', 'revenue']
  WHEN 'product_added_to_cart' THEN ['item_id', 'item_name'] WHEN 'checkout_started' THEN ['step'] WHEN 'page_viewed' THEN CAST([] AS VARCHAR[]) END"""
ALLOWED = """CASE event_name WHEN 'checkout_completed' THEN ['transaction_id', 'revenue', 'currency', 'items', 'coupon']
  WHEN 'purchase' THEN ['transaction_id', 'revenue'] WHEN 'product_added_to_cart' THEN ['item_id', 'item_name', 'quantity', 'price']
  WHEN 'checkout_started' THEN ['step', 'cart_value'] WHEN 'page_viewed' THEN ['title', 'query_params'] END"""
AMOUNT = f"coalesce({json_text('revenue')}, {json_text('value')}, {json_text('total')})"

R1 = " UNION ALL ".join(
    finding("R1_required_column", "'CRITICAL'", "schema_drift", f"'{c}'", "1",
            f"FROM (SELECT event_date FROM raw GROUP BY 1 HAVING count({expr}) = 0)")
    for c, expr in {"client_id": "coalesce(cid_old, cid_new)", "page_url": "page_url", "referrer": "referrer",
                    "timestamp": '"timestamp"', "event_name": "event_name", "event_data": "event_data",
                    "user_agent": "NULL"}.items())
R2_SOURCE = "FROM raw WHERE event_id % 101 = 3 GROUP BY event_date"
R2 = finding("R2_timestamp", "'CRITICAL'", "malformed_timestamp", "'timestamp'", "count(*)", R2_SOURCE)
P3 = finding("P3_alternate_column", "'WARNING'", "schema_drift", "'clientId'", "count(cid_new)",
             "FROM raw GROUP BY event_date HAVING count(cid_new) > 0")
R3 = finding("R3_null_identity", "CASE WHEN nulls / total > 0.2 THEN 'CRITICAL' ELSE 'WARNING' END",
             "high_client_id_nulls", "'client_id'", "nulls", """FROM (SELECT event_date, count(*) AS total,
             count(*) FILTER (WHERE cid_old IS NULL AND cid_new IS NULL) AS nulls FROM raw GROUP BY 1)
             WHERE nulls / total > 0.05""")  # fmt: skip
R4_EMPTY = finding("R4_payload_empty", "'WARNING'", "missing_event_payloads", "event_name", "count(*)",
                   f"FROM raw WHERE (trim(coalesce(event_data, '')) = '' OR (NOT {NO_OBJECT} AND len({KEYS}) = 0)) "
                   "AND event_name <> 'page_viewed' GROUP BY event_date, event_name")
R4_JSON = finding("R4_payload_json", "'CRITICAL'", "missing_event_payloads", "event_name", "count(*)",
                  f"FROM raw WHERE {NO_OBJECT} GROUP BY event_date, event_name")
R5 = finding("R5_required_key", "'CRITICAL'", "missing_key", "key", "count(*)", f"""FROM (
  SELECT event_date, unnest(list_filter({REQUIRED}, lambda k: NOT list_contains({KEYS}, k))) AS key FROM raw)
  GROUP BY event_date, key""")  # fmt: skip
R6 = finding("R6_unknown_key", "'INFO'", "unknown_key", "key", "count(*)", f"""FROM (
  SELECT event_date, unnest(list_filter({KEYS}, lambda k: NOT list_contains({ALLOWED}, k))) AS key FROM raw)
  GROUP BY event_date, key""")  # fmt: skip
R7 = finding("R7_revenue_numeric", "'CRITICAL'", "revenue_not_numeric", "'revenue'", "count(*)", f"""FROM raw
  WHERE event_name = 'checkout_completed' AND {json_text('revenue')} IS NOT NULL
    AND TRY_CAST({json_text('revenue')} AS DOUBLE) IS NULL GROUP BY event_date""")  # fmt: skip
R11 = finding("R11_revenue_positive", "'CRITICAL'", "revenue_not_positive", "'revenue'", "count(*)", f"""FROM raw
  WHERE {BUYS} AND {AMOUNT} IS NOT NULL AND coalesce(TRY_CAST({AMOUNT} AS DOUBLE), 0) <= 0 GROUP BY event_date""")
R8 = finding("R8_duplicate_row", "'WARNING'", "duplicate_row", "CAST(NULL AS VARCHAR)", "count(*) - count(DISTINCT event_id)",
             "FROM raw GROUP BY event_date HAVING count(*) > count(DISTINCT event_id)")
R9 = finding("R9_duplicate_transaction", "'CRITICAL'", "duplicate_transaction", "t", "count(*)", f"""FROM (
  SELECT *, count(*) OVER (PARTITION BY t) AS seen FROM (SELECT event_date, nullif({json_text('transaction_id')}, '') AS t FROM raw WHERE {BUYS})
  WHERE t IS NOT NULL) WHERE seen > 1 GROUP BY event_date, t""")  # fmt: skip
R10 = finding("R10_purchase_follows_checkout", "'CRITICAL'", "checkout_mismatch", "'checkout_completed'", "c - s",
              """FROM (SELECT event_date, count(*) FILTER (WHERE event_name = 'checkout_completed') AS c,
              count(*) FILTER (WHERE event_name = 'checkout_started') AS s FROM raw GROUP BY 1) WHERE c > s""")  # fmt: skip
R12 = finding("R12_timestamp_range", "'WARNING'", "timestamp_out_of_range", "'timestamp'", "count(*)",
              "FROM raw WHERE abs(event_id % 11 - 5) > 3 GROUP BY event_date")
R14_JSON = finding("R14_column_type", "'WARNING'", "column_type", "'event_data'", "count(*)",
                   "FROM raw WHERE event_data IS NOT NULL AND NOT json_valid(event_data) GROUP BY event_date")
R14_TIME = finding("R14_column_type", "'WARNING'", "column_type", "'timestamp'", "count(*)", R2_SOURCE)

R15 = finding("R15_volume", "'WARNING'", "volume_anomaly", "'rows'", "n", """FROM (SELECT event_date, n,
  avg(n) OVER (ORDER BY event_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS usual FROM (
    SELECT event_date, count(*) AS n FROM raw GROUP BY 1)) WHERE n < usual * 0.5 OR n > usual * 1.5""")
R12_FILE = finding("R12_timestamp_range", "'WARNING'", "timestamp_out_of_range", "'timestamp'", "count(*)",
                   "FROM raw WHERE event_id % 89 = 0 GROUP BY event_date")

ROW_RULES = (R4_EMPTY, R4_JSON, R5, R6, R7, R11)


def union(*parts: str) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def _rule(name: str, sql: str, rule: str, inputs=lambda x: x.raw) -> None:
    @query(name, sql)
    def _(x: Inputs):
        return contract.row_violations(inputs(x)).where(F.col("rule").startswith(rule))


def _text_time(x: Inputs):
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return x.raw.withColumn("timestamp", F.when(F.col("event_id") % 101 == 3, "soon").otherwise(text))


def _late_files(x: Inputs):
    """Every 89th event arrives four days late, in the file of that day."""
    late = F.when(F.col("event_id") % 89 == 0, 4).otherwise(0)
    return x.raw.withColumn("file", F.date_format(F.date_add("event_date", late), "'events_'yyyyMMdd'.csv'"))


# A day of three times the events.
TRIPLED = "SELECT * FROM raw UNION ALL SELECT raw.* FROM raw, range(2) WHERE event_date = DATE '2024-01-18'"


def _tripled(x: Inputs):
    times = F.when(F.col("event_date") == "2024-01-18", 3).otherwise(1)
    return x.raw.withColumn("again", F.explode(F.sequence(F.lit(1), times))).drop("again")


def _with_ingest(x: Inputs):
    shift = (F.col("event_id") % 11 - 5).cast("int")
    return x.raw.withColumn("ingest_date", F.date_add("event_date", shift))


@query("r1_required_columns", R1)
def _(x):
    return contract.day_violations(x.raw).where(F.col("rule").startswith("R1_"))


_rule("r2_malformed_timestamp", R2, "R2_", _text_time)


@query("r3_null_identity", R3)
def _(x):
    return contract.day_violations(x.raw).where(F.col("rule").startswith("R3_"))


_rule("r4_payload_required", union(R4_EMPTY, R4_JSON), "R4_")
_rule("r5_required_keys", R5, "R5_")
_rule("r6_unknown_keys", R6, "R6_")
# Every 13th purchase states its revenue as a word, every 17th a negative one.
ODD_REVENUE = """(SELECT * REPLACE (CASE WHEN event_name <> 'checkout_completed' THEN event_data
  WHEN event_id % 13 = 0 THEN '{"transaction_id":"A","revenue":"ten"}'
  WHEN event_id % 17 = 0 THEN '{"transaction_id":"B","revenue":-3}' ELSE event_data END AS event_data) FROM raw)"""


def _odd_revenue(x: Inputs):
    buys = F.col("event_name") == "checkout_completed"
    text = F.when(buys & (F.col("event_id") % 13 == 0), '{"transaction_id":"A","revenue":"ten"}').when(
        buys & (F.col("event_id") % 17 == 0), '{"transaction_id":"B","revenue":-3}'
    )
    return x.raw.withColumn("event_data", F.coalesce(text, "event_data"))


_rule("r7_revenue_numeric", R7.replace("FROM raw", f"FROM {ODD_REVENUE}"), "R7_", _odd_revenue)


@query("r8_exact_duplicates", R8)
def _(x):
    return contract.repeated_rows(x.raw)


@query("r9_duplicate_transactions", R9)
def _(x):
    return contract.repeated_transactions(x.raw)


@query("r10_purchase_follows_checkout", R10)
def _(x):
    return contract.day_violations(x.raw).where(F.col("rule").startswith("R10_"))


_rule("r11_revenue_positive", R11.replace("FROM raw", f"FROM {ODD_REVENUE}"), "R11_", _odd_revenue)
_rule("r12_timestamp_range", R12, "R12_", _with_ingest)


@query("r13_notifiable", f"""SELECT {FINDING} FROM ({union(R1, P3, R3, *ROW_RULES, R8, R9, R10, R14_JSON, R15)})
WHERE code IN ('schema_drift', 'high_client_id_nulls', 'missing_event_payloads', 'duplicate_transaction',
  'malformed_timestamp', 'volume_anomaly') AND severity IN ('WARNING', 'CRITICAL')""")
def _(x):
    return contract.notifiable(contract.contract_violations(x.raw))


@query("r14_column_types", union(R14_JSON, R14_TIME))
def _(x):
    return contract.day_violations(_text_time(x)).where(F.col("rule").startswith("R14_"))


@query("r0_contract_violations", union(R1, P3, R3, *ROW_RULES, R8, R9, R10, R12_FILE, R14_JSON, R15))
def _(x):
    return contract.contract_violations(_late_files(x))


@query("r15_volume_anomaly", R15.replace("raw", f"({TRIPLED})"))
def _(x):
    return contract.day_violations(_tripled(x)).where("rule = 'R15_volume'")


@query("p3_drifted_days", P3)
def _(x):
    return contract.day_violations(x.raw).where(F.col("rule").startswith("P3_"))


# ----------------------------------------------------------------------------- monitor

# Days with every situation the monitor looks for: one of three times the events, one nobody
# delivered, one without revenue, one without paid credit, one without any credit.
STRAINED_RAW = f"(SELECT * FROM ({TRIPLED}) WHERE event_date <> DATE '2024-01-12')"
STRAINED_GOLD = """(SELECT conversion_time, CASE WHEN d = DATE '2024-01-05' THEN 0 ELSE revenue END AS revenue,
  CASE d WHEN DATE '2024-01-06' THEN 'Direct' WHEN DATE '2024-01-07' THEN 'Unattributed' ELSE last_click_channel END AS last_click_channel
  FROM (SELECT *, CAST(conversion_time AS DATE) AS d FROM gold_b) WHERE d <> DATE '2024-01-12')"""


def _strained(x: Inputs):
    day = F.to_date("conversion_time")
    gold = x.lean_gold.where(day != "2024-01-12").withColumns({
        "revenue": F.when(day == "2024-01-05", 0.0).otherwise(F.col("revenue")),
        "last_click_channel": F.when(day == "2024-01-06", "Direct").when(day == "2024-01-07", "Unattributed")
        .otherwise(F.col("last_click_channel")),
    })
    return monitor.checked_days(_tripled(x).where("event_date <> DATE '2024-01-12'"), gold, monitor.ALL_DATES)


def monitor_days(raw: str = "raw", gold: str = "gold_b") -> str:
    """Every day from the first to the last with what both tables say of it."""
    both = f"SELECT * FROM ({MONITOR_RAW.format(raw=raw)}) FULL JOIN ({MONITOR_GOLD.format(gold=gold)}) USING (day)"
    return f"""SELECT * FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM ({both}))
      LEFT JOIN ({both}) USING (day)"""


MONITOR_RAW = """
  SELECT *, avg(n) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean FROM (
    SELECT event_date AS day, count(*) AS n, avg(CASE WHEN coalesce(cid_old, cid_new) IS NULL THEN 1.0 ELSE 0.0 END) AS null_ids,
      avg(CASE WHEN coalesce(referrer, '') = '' THEN 1.0 ELSE 0.0 END) AS no_referrer FROM {raw} GROUP BY 1)"""
_DEC = "CAST(revenue AS DECIMAL(18, 2))"
MONITOR_GOLD = f"""
  SELECT CAST(conversion_time AS DATE) AS day, CAST(sum({_DEC}) AS DOUBLE) AS total,
    coalesce(CAST(sum({_DEC}) FILTER (WHERE last_click_channel IN ('Paid Search', 'Paid Social')) AS DOUBLE), 0) AS paid,
    coalesce(CAST(sum({_DEC}) FILTER (WHERE last_click_channel = 'Unattributed') AS DOUBLE), 0) AS lost
  FROM {{gold}} GROUP BY 1"""
MONITOR_DAYS = monitor_days()
STRAINED_DAYS = monitor_days(STRAINED_RAW, STRAINED_GOLD)
MONITOR_TESTS = {
    "NO_DATA": ("P0", "n IS NULL"),
    "VOLUME_ANOMALY": ("P0", "mean > 0 AND (n < mean * 0.5 OR n > mean * 1.5)"),
    "GHOST_USERS": ("P1", "null_ids > 0.05"),
    "REFERRER_BLACKOUT": ("P0", "no_referrer > 0.9"),
    "ZERO_REVENUE": ("P0", "coalesce(total, 0) = 0"),
    "PAID_BLINDNESS": ("P0", "total > 1000 AND paid = 0"),
    "HIGH_UNATTRIBUTED": ("P1", "total <> 0 AND lost / total > 0.4"),
}


def monitor_alerts_sql(*codes: str, days: str = MONITOR_DAYS) -> str:
    return union(*[
        f"SELECT day AS check_date, '{MONITOR_TESTS[c][0]}' AS severity, '{c}' AS code FROM ({days}) WHERE {MONITOR_TESTS[c][1]}"
        for c in codes or MONITOR_TESTS
    ])


def _checked(x: Inputs, check_date=monitor.ALL_DATES):
    return monitor.checked_days(x.raw, x.lean_gold, check_date)


def _codes(x: Inputs, *codes: str, checked=_checked):
    rows = monitor.alert_rows(checked(x), "2024-01-31")
    return rows.where(F.col("code").isin(*codes)).select("check_date", "severity", "code")


@query("m0_check_date", "SELECT CAST(max(conversion_time) AS DATE) AS check_date FROM gold_b")
def _(x):
    return monitor.dates_to_check(x.raw, x.lean_gold)


@query("m1_missing_raw_columns", f"""
SELECT day AS check_date, code, message FROM ({MONITOR_DAYS}), (VALUES
  ('MISSING_RAW_COL', 'Missing Raw Column: referrer')) v(code, message)""")
def _(x):
    checked = monitor.checked_days(x.raw.drop("referrer"), x.lean_gold, monitor.ALL_DATES)
    rows = monitor.alert_rows(checked, "2024-01-31")
    return rows.where("code LIKE 'MISSING%'").select("check_date", "code", "message")


@query("m2_missing_gold_columns", f"""
SELECT day AS check_date, code, message FROM ({MONITOR_DAYS}), (VALUES
  ('MISSING_GOLD_COL', 'Missing Gold Column: first_click_channel')) v(code, message)""")
def _(x):
    checked = monitor.checked_days(x.raw, x.lean_gold.drop("first_click_channel"), monitor.ALL_DATES)
    rows = monitor.alert_rows(checked, "2024-01-31")
    return rows.where("code LIKE 'MISSING%'").select("check_date", "code", "message")


@query("m3_no_data", """
SELECT DISTINCT CAST(conversion_time AS DATE) AS check_date, 'NO_DATA' AS code FROM gold_b WHERE CAST(conversion_time AS DATE) >= DATE '2024-01-25'""")
def _(x):
    early = x.raw.where("event_date < DATE '2024-01-25'")
    rows = monitor.alert_rows(monitor.checked_days(early, x.lean_gold, monitor.ALL_DATES), "2024-01-31")
    return rows.where("code = 'NO_DATA'").select("check_date", "code")


@query("m4_volume_anomaly", f"""
SELECT day AS check_date, printf('Row volume (%d) deviated >50%% from 7-day avg (%d)', n, CAST(trunc(mean) AS BIGINT)) AS message
FROM ({STRAINED_DAYS}) WHERE {MONITOR_TESTS["VOLUME_ANOMALY"][1]}""")
def _(x):
    rows = monitor.alert_rows(_strained(x), "2024-01-31")
    return rows.where("code = 'VOLUME_ANOMALY'").select("check_date", "message")


@query("m5_null_identity", monitor_alerts_sql("GHOST_USERS"))
def _(x):
    return _codes(x, "GHOST_USERS")


@query("m6_referrer_blackout", monitor_alerts_sql("REFERRER_BLACKOUT"))
def _(x):
    return _codes(x, "REFERRER_BLACKOUT")


@query("m7_zero_revenue", monitor_alerts_sql("ZERO_REVENUE", days=STRAINED_DAYS))
def _(x):
    return _codes(x, "ZERO_REVENUE", checked=_strained)


@query("m8_paid_blindness", monitor_alerts_sql("PAID_BLINDNESS", days=STRAINED_DAYS))
def _(x):
    return _codes(x, "PAID_BLINDNESS", checked=_strained)


@query("m9_high_unattributed", monitor_alerts_sql("HIGH_UNATTRIBUTED", days=STRAINED_DAYS))
def _(x):
    return _codes(x, "HIGH_UNATTRIBUTED", checked=_strained)


STATUS_SQL = f"""
SELECT day AS check_date, CASE WHEN bool_or(severity = 'P0') THEN 'RED' WHEN bool_or(severity = 'P1') THEN 'YELLOW' ELSE 'GREEN' END AS status,
  count(code) AS alerts
FROM ({MONITOR_DAYS}) LEFT JOIN ({monitor_alerts_sql()}) a ON a.check_date = day GROUP BY 1"""


@query("m10_status_per_day", STATUS_SQL)
def _(x):
    return monitor.status_rows(_checked(x))


@query("m10_strained_days", STATUS_SQL.replace(MONITOR_DAYS, STRAINED_DAYS))
def _(x):
    return monitor.status_rows(_strained(x))


@query("m11_monitor_latest_day", f"SELECT * FROM ({STATUS_SQL}) ORDER BY check_date DESC LIMIT 1")
def _(x):
    return monitor.status_rows(_checked(x, None))


# What each alert says, and the figures it carries.
FIGURES = ("count", "avg", "rate", "total_rev", "paid_rev", "share")
MONITOR_TEXTS = {
    "NO_DATA": ("'No raw rows found for date ' || day", {}),
    "VOLUME_ANOMALY": ("printf('Row volume (%d) deviated >50%% from 7-day avg (%d)', n, CAST(trunc(mean) AS BIGINT))",
                       {"count": "n", "avg": "trunc(mean)"}),
    "GHOST_USERS": ("printf('Null Client ID Rate: %.1f%%', null_ids * 100)", {"rate": "null_ids"}),
    "REFERRER_BLACKOUT": ("printf('Missing Referrer Rate: %.1f%%', no_referrer * 100)", {"rate": "no_referrer"}),
    "ZERO_REVENUE": ("'Total Revenue is $0.00 for ' || day", {}),
    "PAID_BLINDNESS": ("format('Total Rev is ${:,} but Paid Channel Rev is $0. Check UTM parsing.', CAST(round(total) AS BIGINT))",
                       {"total_rev": "total", "paid_rev": "paid"}),
    "HIGH_UNATTRIBUTED": ("printf('Unattributed Share is %.1f%%', lost / total * 100)", {"share": "lost / total"}),
}


def _texts_sql(code: str) -> str:
    (severity, test), (text, figures) = MONITOR_TESTS[code], MONITOR_TEXTS[code]
    columns = ", ".join(f"round(CAST({figures.get(f, 'NULL')} AS DOUBLE), 6) AS {f}" for f in FIGURES)
    return f"""SELECT TIMESTAMP '2024-01-31' AS "timestamp", day AS check_date, '{severity}' AS severity, '{code}' AS code,
      {text} AS message, {columns} FROM ({STRAINED_DAYS}) WHERE {test}"""


@query("m12_monitor_alerts", union(*map(_texts_sql, MONITOR_TESTS)))
def _(x):
    rows = monitor.alert_rows(_strained(x), "2024-01-31")
    return rows.withColumns({f: F.round(F.col("details")[f], 6) for f in FIGURES}).drop("details")


@query("a25_global_status", STATUS_SQL.replace("count(code) AS alerts", "max(severity) AS least_severity"))
def _(x):
    checked = _checked(x)
    return monitor.status_rows(checked).join(
        checked.select("check_date", F.array_max(F.transform("alerts", lambda a: a["severity"])).alias("least_severity")),
        "check_date",
    ).drop("alerts")


# ------------------------------------------------------------------------------ checks

EXPECT = checks.Expectations("u1", "u2", "T0", "u3", "T3")
CLICK = "(SELECT min({which}_click_channel) FROM gold WHERE transaction_id = '{t}')"
CHECK_SQL = {
    "A_first_event_session": """SELECT CASE WHEN count(*) = 1 THEN 'PASS' ELSE 'FAIL' END AS result,
      'expected=1 actual=' || count(*) AS details FROM ses WHERE user_id = 'u1'""",
    "B_session_boundary_30min": """SELECT CASE WHEN count(*) = 2 THEN 'PASS' ELSE 'FAIL' END AS result,
      'expected=2 actual=' || count(DISTINCT session_id) AS details FROM ses WHERE user_id = 'u2'""",
    "C_intra_session_first_last": f"""SELECT CASE WHEN f = 'Organic Search' AND l = 'Paid Search' THEN 'PASS' ELSE 'FAIL' END AS result,
      'first=' || coalesce(f, 'none') || ' last=' || coalesce(l, 'none') AS details
      FROM (SELECT {CLICK.format(which='first', t='T0')} AS f, {CLICK.format(which='last', t='T0')} AS l)""",
    "D_7day_inclusive": """SELECT CASE WHEN count(*) >= 1 THEN 'PASS' ELSE 'FAIL' END AS result,
      'sessions=' || count(*) AS details FROM ses WHERE user_id = 'u3'""",
    "E_direct_when_no_prior": f"""SELECT CASE WHEN f = 'Direct' AND l = 'Direct' THEN 'PASS' ELSE 'FAIL' END AS result,
      'first=' || coalesce(f, 'none') || ' last=' || coalesce(l, 'none') AS details
      FROM (SELECT {CLICK.format(which='first', t='T3')} AS f, {CLICK.format(which='last', t='T3')} AS l)""",
    "F_conversion_count_dedupe": f"""SELECT CASE WHEN r = a THEN 'PASS' ELSE 'FAIL' END AS result,
      'raw=' || r || ' attributed=' || a AS details FROM (
      SELECT (SELECT count(DISTINCT transaction_id) FROM staged WHERE {BUYS}) AS r, (SELECT count(*) FROM gold) AS a)""",
    "G_revenue_parity": f"""SELECT CASE WHEN r = a THEN 'PASS' ELSE 'FAIL' END AS result,
      'raw=' || r || ' attributed=' || a AS details FROM (SELECT
      (SELECT sum(m) FROM (SELECT max(CAST(coalesce(revenue, 0) AS DECIMAL(18, 2))) AS m FROM staged
        WHERE {BUYS} AND transaction_id IS NOT NULL GROUP BY transaction_id)) AS r,
      (SELECT sum(CAST(revenue AS DECIMAL(18, 2))) FROM gold) AS a)""",
    "H_session_start_before_end": """SELECT CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
      'bad_sessions=' || count(*) AS details FROM ses WHERE session_start_ts > session_end_ts""",
    "I_non_null_user_id_in_staging": """SELECT CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
      'null_user_ids=' || count(*) AS details FROM staged WHERE user_id IS NULL""",
}


def _summary(x: Inputs):
    return checks.validation_summary(x.staged(), x.sessions(), x.gold(), EXPECT)


def _check(letter: str, name: str, sql: str) -> None:
    # The start times shown for A and D are engine-specific text; the result is compared.
    with_details = letter not in "AD"
    columns = ("test_name", "result", "details") if with_details else ("test_name", "result")

    @query(f"t{letter.lower()}_{name[2:].lower()}", f"SELECT {', '.join(columns)} FROM (SELECT '{name}' AS test_name, * FROM ({sql}))")
    def _(x: Inputs):
        return _summary(x).where(F.col("test_name") == name).select(*columns)


for _name, _sql in CHECK_SQL.items():
    _check(_name[0], _name, _sql)


@query("tz_validation_summary", union(*[f"SELECT '{n}' AS test_name, result FROM ({s})" for n, s in CHECK_SQL.items()]))
def _(x):
    return _summary(x).select("test_name", "result")


# -------------------------------------------------------------------------- dashboards

AS_OF = "2024-01-28 12:00:00"
REVENUE = f"CAST(sum({_DEC}) AS DOUBLE)"


def _daily(days: int) -> str:
    return f"""SELECT CAST(conversion_time AS DATE) AS day, {REVENUE} AS revenue FROM gold
      WHERE conversion_time >= TIMESTAMP '{AS_OF}' - INTERVAL {days} DAY GROUP BY 1"""


@query("d1_daily_revenue", _daily(14))
def _(x):
    return dashboards.daily_revenue(x.gold(), AS_OF)


@query("d1a_revenue_drops", f"""
SELECT * FROM (SELECT day, revenue, (revenue - lag(revenue) OVER (ORDER BY day)) / lag(revenue) OVER (ORDER BY day) AS change
  FROM ({_daily(14)})) WHERE change < -0.3""")
def _(x):
    return dashboards.revenue_drops(x.gold(), AS_OF)


def _mix(days: int) -> str:
    return f"""SELECT last_click_channel AS channel, {REVENUE} AS revenue FROM gold
      WHERE conversion_time >= TIMESTAMP '{AS_OF}' - INTERVAL {days} DAY GROUP BY 1"""


@query("d2_channel_mix", _mix(7))
def _(x):
    return dashboards.channel_mix(x.gold(), AS_OF)


@query("d3_paid_revenue_today", f"""
SELECT coalesce({REVENUE}, 0) AS paid_revenue, coalesce({REVENUE}, 0) < 1 AS alert FROM gold
WHERE CAST(conversion_time AS DATE) = DATE '2024-01-28' AND last_click_channel IN ('Paid Search', 'Paid Social')""")
def _(x):
    return dashboards.paid_revenue_today(x.gold(), AS_OF)


@query("d4_event_volume", f"""
SELECT event_date AS day, count(*) AS events FROM staged WHERE event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1""")
def _(x):
    return dashboards.event_volume(x.staged(), AS_OF)


def _recent_alerts(x: Inputs):
    rows = monitor.alert_rows(_checked(x), AS_OF)
    return rows.withColumn("timestamp", F.col("check_date").cast("timestamp"))


@query("d5_latest_alerts", f"""
SELECT CAST(check_date AS TIMESTAMP) AS "timestamp", severity, code FROM ({monitor_alerts_sql()})
WHERE check_date >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR ORDER BY 1 DESC, 2, 3 LIMIT 50""")
def _(x):
    return dashboards.latest_alerts(_recent_alerts(x), AS_OF).drop("message")


@query("o5_latest_alerts_top", f"""
SELECT CAST(check_date AS TIMESTAMP) AS "timestamp", severity, code FROM ({monitor_alerts_sql()})
WHERE check_date >= TIMESTAMP '{AS_OF}' - INTERVAL 600 HOUR ORDER BY 1 DESC, 2, 3 LIMIT 5""")
def _(x):
    return dashboards.latest_alerts(_recent_alerts(x), AS_OF, hours=600, shown=5).drop("message")


@query("d6_date_ranges", union(*[
    f"SELECT {d} AS days, 'revenue' AS panel, CAST(day AS VARCHAR) AS label, revenue AS amount FROM ({_daily(d)})" for d in (7, 14, 30)],
    *[f"SELECT {d} AS days, 'mix' AS panel, channel AS label, revenue AS amount FROM ({_mix(d)})" for d in (7, 14, 30)]))
def _(x):
    gold = x.gold()
    parts = []
    for days in (7, 14, 30):
        revenue = dashboards.daily_revenue(gold, AS_OF, days).withColumn("panel", F.lit("revenue"))
        mix = dashboards.channel_mix(gold, AS_OF, days).withColumn("panel", F.lit("mix"))
        parts.append(revenue.select(F.lit(days).alias("days"), "panel", F.col("day").cast("string").alias("label"), F.col("revenue").alias("amount")))
        parts.append(mix.select(F.lit(days).alias("days"), "panel", F.col("channel").alias("label"), F.col("revenue").alias("amount")))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


# ----------------------------------------------------------------------------- metrics

STAGE = """count(*) FILTER (WHERE event_name = 'page_viewed') AS v, count(*) FILTER (WHERE event_name = 'product_added_to_cart') AS c,
  count(*) FILTER (WHERE event_name = 'checkout_started') AS s, count(*) FILTER (WHERE event_name = 'checkout_completed') AS p"""


@query("n1_funnel", f"""
SELECT unnest([1, 2, 3, 4]) AS position, unnest(['Site Visitors', 'Add to Cart', 'Checkout', 'Purchase']) AS stage,
  unnest([v, c, s, p]) AS events FROM (SELECT {STAGE} FROM raw)""")
def _(x):
    return metrics.funnel(x.raw)


@query("n2_conversion_rates", f"""
SELECT p / v AS purchase_rate, c / v AS cart_rate, p / s AS checkout_completion FROM (SELECT {STAGE} FROM raw)""")
def _(x):
    return metrics.conversion_rates(x.raw)


@query("n3_attribution_coverage", f"""
SELECT coverage, CAST(sum(r) AS DOUBLE) AS revenue, CAST(sum(r) AS DOUBLE) / sum(sum(CAST(r AS DOUBLE))) OVER () AS share FROM (
  SELECT CASE WHEN channel = 'Unattributed' THEN channel
    WHEN row_number() OVER (PARTITION BY channel <> 'Unattributed' ORDER BY r DESC NULLS LAST, channel) = 1 THEN channel ELSE 'Other' END AS coverage, r
  FROM (SELECT last_click_channel AS channel, sum({_DEC}) AS r FROM gold_b GROUP BY 1)) GROUP BY 1""")
def _(x):
    return metrics.attribution_coverage(x.lean_gold).withColumn("share", F.round("share", 9))


@query("n4_prior_session_share", """
SELECT count(*) AS conversions, count(*) FILTER (WHERE touches > 0) AS with_prior_session,
  avg(CASE WHEN touches > 0 THEN 1.0 ELSE 0.0 END) AS share FROM gold_b""")
def _(x):
    staged = x.staged(PANDAS)
    matched = match_sessions(conversions(staged, PANDAS), x.sessions(PANDAS), PANDAS)
    return metrics.prior_session_share(matched)


@query("n5_identity_completeness", """
SELECT event_date, avg(CASE WHEN cid_old IS NULL THEN 0.0 ELSE 1.0 END) AS client_id_share,
  avg(CASE WHEN cid_new IS NULL THEN 0.0 ELSE 1.0 END) AS alternate_share FROM raw GROUP BY 1""")
def _(x):
    return metrics.identity_completeness(x.raw)


@query("n6_purchase_tagging", f"""
SELECT count(*) AS purchases, avg(CASE WHEN cid_old IS NULL THEN 0.0 ELSE 1.0 END) AS client_id_share,
  avg(CASE WHEN regexp_matches(page_url, '[?&]utm_') THEN 1.0 ELSE 0.0 END) AS utm_share FROM raw WHERE {BUYS}""")
def _(x):
    return metrics.purchase_tagging(x.raw)


@query("n7_revenue_inflation", f"""
SELECT CAST(sum(a) AS DOUBLE) AS gross_revenue, CAST(sum(b) AS DOUBLE) AS net_revenue, CAST(sum(a) - sum(b) AS DOUBLE) AS inflation FROM (
  SELECT transaction_id, sum({_DEC}) AS a, max({_DEC}) AS b FROM staged WHERE {BUYS} AND transaction_id IS NOT NULL GROUP BY 1)""")
def _(x):
    return metrics.revenue_inflation(x.staged())


@query("n8_revenue_by_source", f"""
SELECT utm_source, coalesce({REVENUE}, 0) AS revenue, count(*) AS purchases FROM staged WHERE {BUYS} GROUP BY 1""")
def _(x):
    return metrics.revenue_by_source(x.staged())


@query("n9_period_totals", f"""
SELECT count(*) AS events, count(*) FILTER (WHERE {BUYS}) AS purchases,
  CAST(sum(CAST({first_nonzero("value", "revenue", "total")} AS DECIMAL(18, 2))) FILTER (WHERE {BUYS}) AS DOUBLE) AS revenue FROM raw""")
def _(x):
    return metrics.period_totals(x.raw)


AGENTS = ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_0)", "Mozilla/5.0 (Linux; Android 14) Mobile", "Mozilla/5.0 (Windows NT 10.0)")


@query("n10_device_split", f"""
SELECT device, v + c + s + p + e AS events, p / v AS purchase_rate, c / v AS cart_rate, p / s AS checkout_completion FROM (
  SELECT CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'mobile' WHEN 2 THEN 'desktop' ELSE 'unknown' END AS device, {STAGE},
    count(*) FILTER (WHERE event_name = 'email_filled_on_popup') AS e FROM raw GROUP BY 1)""")
def _(x):
    kind = F.col("event_id") % 4
    agent = F.when(kind == 0, AGENTS[0]).when(kind == 1, AGENTS[1]).when(kind == 2, AGENTS[2])
    return metrics.device_split(x.raw.withColumn("user_agent", agent))
