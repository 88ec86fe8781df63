"""Queries for the planned extensions: multi-touch credit, cohorts, features, upkeep."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from clickloom.config import PANDAS, SQL
from clickloom.operators import contract, customers, funnel, models, multi_touch, upkeep
from clickloom.operators.attribution import attribute_events
from clickloom.operators.normalize import is_conversion
from clickloom.plans.comparison_sql import BUYS
from clickloom.plans.queries_basic import CRITICAL_ROW, KEYS
from clickloom.plans.queries_sessions import GOLD
from clickloom.plans.registry import Inputs, query
from clickloom.sources import quarantine, tables

TOUCHES = """
  SELECT c.transaction_id, c.user_id, coalesce(c.revenue, 0) AS revenue, c.conversion_ts, s.session_start_ts AS touched_at,
    coalesce(s.session_first_channel, 'Direct') AS channel
  FROM conv c LEFT JOIN ses s ON s.user_id = c.user_id AND s.session_start_ts <= c.conversion_ts
    AND s.session_start_ts >= c.conversion_ts - INTERVAL 7 DAY"""


def _credit(weight: str) -> str:
    return f"""SELECT transaction_id, user_id, channel, round(w, 6) AS weight, round(revenue * w, 6) AS credit FROM (
      SELECT transaction_id, user_id, channel, any_value(revenue) AS revenue,
        sum({weight}) / sum(sum({weight})) OVER (PARTITION BY transaction_id, user_id) AS w FROM ({TOUCHES}) GROUP BY 1, 2, 3)"""


def _rounded(df):
    return df.withColumn("weight", F.round("weight", 6)).withColumn("credit", F.round("credit", 6))


@query("x1_linear_credit", _credit("1.0"))
def _(x):
    return _rounded(multi_touch.spread_credit(multi_touch.touch_paths(x.staged())))


@query("x1_time_decay_credit", _credit(
    "coalesce(pow(0.5, (epoch_us(conversion_ts) - epoch_us(touched_at)) / 1e6 / (7 * 86400)), 1)"))
def _(x):
    return _rounded(multi_touch.spread_credit(multi_touch.touch_paths(x.staged()), "time_decay"))


@query("x2_shapley_values", f"""
SELECT channel, round(sum(revenue / n), 4) AS value FROM (
  SELECT *, count(*) OVER (PARTITION BY transaction_id, user_id) AS n FROM (
    SELECT DISTINCT transaction_id, user_id, revenue, channel FROM ({TOUCHES}))) GROUP BY 1""")
def _(x):
    values = multi_touch.shapley_values(multi_touch.touch_paths(x.staged()))
    return values.withColumn("value", F.round("value", 4))


def _orders(x: Inputs):
    return customers.daily_purchases(x.table("orders"), "o_custkey", "o_orderdate", "o_totalprice")


ORDER_DAYS = """
  SELECT user_id, day, first_day, CAST(date_trunc('month', first_day) AS DATE) AS cohort, (day - first_day) // 90 AS bucket, purchases, revenue FROM (
    SELECT *, min(day) OVER (PARTITION BY user_id) AS first_day FROM (
      SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, count(*) AS purchases,
        sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS revenue FROM orders GROUP BY 1, 2))"""


@query("x3_cohort_retention", f"SELECT cohort, bucket, count(DISTINCT user_id) AS users FROM ({ORDER_DAYS}) GROUP BY 1, 2")
def _(x):
    return customers.cohort_retention(_orders(x), "month", 90)


# Ages in buckets of 90 days: the orders cover less than seven years.
AGES = 28


@query("x3_retention_table", "SELECT cohort, " + ", ".join(
    f'count(DISTINCT user_id) FILTER (WHERE bucket = {i}) AS "{i}"' for i in range(AGES)) + f" FROM ({ORDER_DAYS}) GROUP BY 1")
def _(x):
    return customers.retention_table(_orders(x), AGES, "month", 90)


@query("x4_customer_value", f"""
SELECT user_id, DATE '2000-01-01' - max(day) AS recency_days, CAST(sum(purchases) AS BIGINT) AS frequency,
  CAST(sum(revenue) AS DOUBLE) AS revenue, min(day) AS first_day FROM ({ORDER_DAYS}) GROUP BY 1""")
def _(x):
    return customers.customer_value(_orders(x), "2000-01-01")


@query("x4_cohort_value", f"""
SELECT cohort, bucket, CAST(r AS DOUBLE) AS revenue,
  CAST(sum(r) OVER (PARTITION BY cohort ORDER BY bucket) AS DOUBLE) AS cumulative_revenue
FROM (SELECT cohort, bucket, sum(revenue) AS r FROM ({ORDER_DAYS}) GROUP BY 1, 2)""")
def _(x):
    return customers.cohort_value(_orders(x), "month", 90)


STEPS = ("page_viewed", "product_added_to_cart", "checkout_started", "checkout_completed")


def _step(i: int) -> str:
    if i == 0:
        return f"SELECT user_id, min(event_ts) AS t FROM staged WHERE event_name = '{STEPS[0]}' GROUP BY 1"
    return f"""SELECT e.user_id, min(e.event_ts) AS t FROM staged e JOIN ({_step(i - 1)}) p
      ON e.user_id = p.user_id AND e.event_ts > p.t WHERE e.event_name = '{STEPS[i]}' GROUP BY 1"""


@query("x5_ordered_funnel", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{s}' AS step, count(*) AS users FROM ({_step(i)})" for i, s in enumerate(STEPS)))
def _(x):
    return funnel.ordered_funnel(x.staged(), STEPS)


@query("x6_two_variant_test", f"""
SELECT n_a, n_b, s_a, s_b, round(z, 9) AS z, abs(z) > 1.959964 AS significant FROM (
  SELECT *, (s_b / n_b - s_a / n_a) / sqrt(p * (1 - p) * (1 / n_a + 1 / n_b)) AS z FROM (
    SELECT *, (s_a + s_b) / (n_a + n_b) AS p FROM (
      SELECT count(*) FILTER (WHERE event_id % 2 = 0) AS n_a, count(*) FILTER (WHERE event_id % 2 = 1) AS n_b,
        count(*) FILTER (WHERE event_id % 2 = 0 AND {BUYS}) AS s_a, count(*) FILTER (WHERE event_id % 2 = 1 AND {BUYS}) AS s_b FROM raw)))""")
def _(x):
    variant = F.when(F.col("event_id") % 2 == 0, "A").otherwise("B")
    return customers.two_variant_test(x.raw, variant, is_conversion()).withColumn("z", F.round("z", 9))


@query("x7_purchase_frequency", f"""
SELECT user_id, day, CAST(sum(purchases) OVER w AS BIGINT) AS purchases_window, CAST(sum(revenue) OVER w AS DOUBLE) AS revenue_window
FROM ({ORDER_DAYS}) WINDOW w AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
def _(x):
    return customers.purchase_frequency(_orders(x))


@query("x8_churn_labels", """
SELECT user_id, max(event_date) AS last_day, DATE '2024-01-30' - max(event_date) > 3 AS churned FROM staged GROUP BY 1""")
def _(x):
    return customers.churn_labels(x.staged(), "2024-01-30", 3)


# The users of the table come nearly every day: a day away is what can be told.
CHURN_CUT, CHURN_DAYS = "2024-01-20", 1


@query("x8_churn_features", f"""
SELECT user_id, CAST(DATE '{CHURN_CUT}' - max(event_date) FILTER (b) AS DOUBLE) AS recency_days,
  CAST(DATE '{CHURN_CUT}' - min(event_date) FILTER (b) AS DOUBLE) AS tenure_days, CAST(count(*) FILTER (b) AS DOUBLE) AS events,
  CAST(count(DISTINCT event_date) FILTER (b) AS DOUBLE) AS active_days,
  CAST(count(*) FILTER (b AND event_date >= DATE '{CHURN_CUT}' - 7) AS DOUBLE) AS recent_events,
  CAST(count(*) FILTER (b AND {BUYS}) AS DOUBLE) AS purchases,
  CAST(coalesce(sum(CAST(revenue AS DECIMAL(18, 2))) FILTER (b AND {BUYS}), 0) AS DOUBLE) AS revenue,
  count(*) FILTER (NOT b) = 0 AS churned
FROM (SELECT *, event_date < DATE '{CHURN_CUT}' AS b FROM staged WHERE event_date < DATE '{CHURN_CUT}' + {CHURN_DAYS}) GROUP BY 1 HAVING bool_or(b)""")
def _(x):
    return models.churn_examples(x.staged(), CHURN_CUT, CHURN_DAYS)


@query("x8_churn_scores")
def _(x):
    return models.fit_churn(models.churn_examples(x.staged(), CHURN_CUT, CHURN_DAYS)).scores


VALUE_CUTS, VALUE_DAYS = ("1997-07-01", "1999-07-01"), 730


@query("x4_value_features", f"""
SELECT user_id, CAST(DATE '{VALUE_CUTS[1]}' - max(day) FILTER (b) AS DOUBLE) AS recency_days,
  CAST(DATE '{VALUE_CUTS[1]}' - min(day) FILTER (b) AS DOUBLE) AS tenure_days,
  CAST(coalesce(sum(purchases) FILTER (b), 0) AS DOUBLE) * {VALUE_DAYS} / greatest(DATE '{VALUE_CUTS[1]}' - min(day) FILTER (b), {VALUE_DAYS}) AS periods_purchases,
  CAST(coalesce(sum(purchases) FILTER (b AND day >= DATE '{VALUE_CUTS[1]}' - {VALUE_DAYS}), 0) AS DOUBLE) AS last_purchases,
  CAST(sum(revenue) FILTER (b) AS DOUBLE) / CAST(sum(purchases) FILTER (b) AS DOUBLE) AS mean_spend,
  CAST(coalesce(sum(revenue) FILTER (b AND day >= DATE '{VALUE_CUTS[1]}' - {VALUE_DAYS}), 0) AS DOUBLE) AS last_revenue,
  CAST(coalesce(sum(purchases) FILTER (NOT b), 0) AS DOUBLE) AS next_purchases, CAST(coalesce(sum(revenue) FILTER (NOT b), 0) AS DOUBLE) AS next_revenue
FROM (SELECT *, day < DATE '{VALUE_CUTS[1]}' AS b FROM ({ORDER_DAYS}) WHERE day < DATE '{VALUE_CUTS[1]}' + {VALUE_DAYS}) GROUP BY 1 HAVING bool_or(b)""")
def _(x):
    return models.value_examples(_orders(x), VALUE_CUTS[1], VALUE_DAYS)


@query("x4_value_predictions")
def _(x):
    daily = _orders(x)
    model = models.fit_value(models.value_examples(daily, VALUE_CUTS[0], VALUE_DAYS))
    return model.predict(models.value_examples(daily, VALUE_CUTS[1], VALUE_DAYS)).select("user_id", "predicted", "next_revenue", "last_revenue")


SUMMARY = f"""
  SELECT event_date, count(*) AS events, count(DISTINCT user_id) AS users, count(*) FILTER (WHERE {BUYS}) AS purchases,
    coalesce(CAST(sum(CAST(revenue AS DECIMAL(18, 2))) FILTER (WHERE {BUYS}) AS DOUBLE), 0) AS revenue FROM staged GROUP BY 1"""


def _anomaly(name: str, column: str) -> None:
    @query(name, f"""
    SELECT event_date, {column}, round(score, 6) AS score, coalesce(abs(score) > 3, false) AS anomaly FROM (
      SELECT *, (CAST({column} AS DOUBLE) - avg({column}) OVER w) / nullif(stddev_samp({column}) OVER w, 0) AS score FROM ({SUMMARY})
      WINDOW w AS (ORDER BY event_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""")
    def _(x):
        scores = upkeep.anomaly_scores(upkeep.daily_summary(x.staged()), column)
        return scores.withColumn("score", F.round("score", 6))


_anomaly("x9_volume_anomaly", "events")
_anomaly("x9_revenue_anomaly", "revenue")


@query("x10_incremental_attribution", f"SELECT {GOLD} FROM gold WHERE conversion_time >= TIMESTAMP '2024-01-20'")
def _(x):
    return upkeep.attribute_since(x.staged(), "2024-01-20")


@query("x10_incremental_attribution_b", f"SELECT {GOLD} FROM gold_b WHERE conversion_time >= TIMESTAMP '2024-01-20'")
def _(x):
    return upkeep.attribute_since(x.staged(PANDAS), "2024-01-20", PANDAS)


def _written_back(staged, settings):
    """Gold of the events before a date, then brought up to date by the run from it on."""
    old = attribute_events(staged.where(F.col("event_ts") < F.lit("2024-01-20").cast("timestamp")), settings)
    return upkeep.merged_gold(old, upkeep.attribute_since(staged, "2024-01-20", settings), "2024-01-20", settings)


@query("x10_gold_after_write_back", f"SELECT {GOLD} FROM gold")
def _(x):
    return _written_back(x.staged(), SQL)


@query("x10_gold_after_write_back_b", f"SELECT {GOLD} FROM gold_b")
def _(x):
    return _written_back(x.staged(PANDAS), PANDAS)


# A later contract that no longer asks for a ``revenue`` key lets most purchases through.
LENIENT = contract.Contract(
    event_rules={
        name: replace(rule, required=tuple(k for k in rule.required if k != "revenue"))
        for name, rule in contract.EVENT_RULES.items()
    }
)

LENIENT_ROW = CRITICAL_ROW.replace(f"NOT list_contains({KEYS}, 'revenue') OR ", "")


@query("x11_quarantine_replay", f"""
SELECT zone, count(*) AS n FROM (
  SELECT CASE WHEN copy > 1 OR {LENIENT_ROW} THEN 'quarantine' ELSE 'clean' END AS zone
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id) AS copy FROM raw) WHERE copy > 1 OR {CRITICAL_ROW}) GROUP BY 1""")
def _(x):
    held = quarantine.route(x.raw).where("zone = 'quarantine'")
    return quarantine.replay(held, LENIENT).groupBy("zone").agg(F.sum("rows").alias("n"))


@query("x12_daily_summary", SUMMARY)
def _(x):
    path = tables.shared_folder(x.spark, "summary")
    tables.overwrite_partitions(upkeep.daily_summary(x.staged()), path)
    return tables.read_table(x.spark, path)


# The mapping has no personal data in texts, so every row gets an address and a long number.
def _scrubbed_sql(text: str) -> str:
    mail = f"regexp_replace({text}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}', '<email>', 'g')"
    return f"regexp_replace({mail}, '\\d{{9,}}', '<number>', 'g')"


@query("x13_masking", f"""
SELECT event_id, sha256('s' || cid_old) AS client_id, sha256('s' || cid_new) AS alternate,
  {_scrubbed_sql("page_url || '&mail=jo.' || event_id || '@mail.example.org'")} AS page_url,
  {_scrubbed_sql("referrer || '?to=a+b%' || event_id || '@x-y.org&id=' || (4000000000 + event_id)")} AS referrer,
  {_scrubbed_sql("coalesce(event_data, '') || ' card ' || (411111111111 + event_id) || ' zip 12345678'")} AS event_data FROM raw""")
def _(x):
    e = F.col("event_id")
    personal = x.raw.withColumns({
        "page_url": F.concat("page_url", F.lit("&mail=jo."), e, F.lit("@mail.example.org")),
        "referrer": F.concat("referrer", F.lit("?to=a+b%"), e, F.lit("@x-y.org&id="), e + 4_000_000_000),
        "event_data": F.concat(F.coalesce("event_data", F.lit("")), F.lit(" card "), e + 411_111_111_111, F.lit(" zip 12345678")),
    })
    found = upkeep.masked(personal, "s")
    return found.select("event_id", "client_id", F.col("clientId").alias("alternate"), "page_url", "referrer", "event_data")


@query("x14_deletion_by_user", """
SELECT event_key AS event_id, user_id FROM staged WHERE user_id NOT IN (
  SELECT user_id FROM staged WHERE event_name = 'checkout_completed' AND revenue > 200)""")
def _(x):
    requests = x.staged().where(is_conversion() & (F.col("revenue") > 200)).select("user_id")
    return upkeep.without_users(x.staged(), requests).select(F.col("event_key").alias("event_id"), "user_id")


@query("x15_revenue_alerts", f"""
SELECT * FROM (SELECT event_date, revenue, (revenue - lag(revenue) OVER (ORDER BY event_date)) / lag(revenue) OVER (ORDER BY event_date) AS change
  FROM ({SUMMARY})) WHERE change < -0.2""")
def _(x):
    return upkeep.revenue_alerts(upkeep.daily_summary(x.staged()))


@query("x15_weekly_report", f"""
SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, CAST(sum(events) AS BIGINT) AS events, CAST(sum(purchases) AS BIGINT) AS purchases,
  CAST(sum(CAST(revenue AS DECIMAL(18, 2))) AS DOUBLE) AS revenue FROM ({SUMMARY}) GROUP BY 1""")
def _(x):
    return upkeep.weekly_report(upkeep.daily_summary(x.staged()))


@query("x16_ingestion_check", f"""
SELECT event_date, count(*) AS accepted FROM raw WHERE NOT coalesce({CRITICAL_ROW}, false) GROUP BY 1""")
def _(x):
    from clickloom.streaming.jobs import validate

    return validate(x.raw).where("zone = 'clean'").groupBy("event_date").agg(F.count(F.lit(1)).alias("accepted"))
