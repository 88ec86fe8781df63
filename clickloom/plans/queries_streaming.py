"""Queries that drive a stream over the events table and read what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import carts
from clickloom.operators.normalize import stage_events
from clickloom.config import PANDAS, SQL, Settings
from clickloom.plans.queries_basic import CRITICAL_ROW
from clickloom.plans.queries_extensions import LENIENT, LENIENT_ROW
from clickloom.plans.queries_sessions import GOLD
from clickloom.plans.registry import Inputs, query
from clickloom.plans.sample_events import as_raw, events_stream
from clickloom.sources.day_store import DayStore
from clickloom.sources.tables import shared_folder
from clickloom.streaming import cart_timers, incremental, jobs, zones


def streamed_raw(x: Inputs) -> DataFrame:
    return as_raw(events_stream(x.spark, x.sf_dir))


def outcome(x: Inputs, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to the end of its input and read its output."""
    path, checkpoint = shared_folder(x.spark, name), shared_folder(x.spark, f"{name}-state")
    jobs.run_available(stream, path, checkpoint)
    return x.spark.read.schema(stream.schema).parquet(path)


def watermark(lateness: str, source: str = "staged") -> str:
    return f"(SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL {lateness} FROM {source})"


@query("st1_streaming_validator", f"""
SELECT event_date, CASE WHEN {CRITICAL_ROW} THEN 'quarantine' ELSE 'clean' END AS zone, count(*) AS n FROM raw GROUP BY ALL""")
def _(x):
    path, checkpoint = shared_folder(x.spark, "zones"), shared_folder(x.spark, "zones-state")
    writer = jobs.write_zones(jobs.validate(streamed_raw(x)), path, checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return x.spark.read.parquet(path).groupBy("event_date", "zone").agg(F.count(F.lit(1)).alias("n"))


@query("st2_streaming_sessions", f"""
SELECT user_id, session_start_ts, session_end_ts, events, session_first_channel, session_last_channel, session_campaign
FROM ses WHERE session_end_ts + INTERVAL 1799999999 MICROSECOND <= {watermark("1 HOUR")}""")
def _(x):
    stream = jobs.sessions(stage_events(streamed_raw(x)), lateness="1 hour")
    return outcome(x, stream, "sessions").drop("session_id")


@query("st3_streaming_dedupe", "SELECT DISTINCT event_key AS event_id, user_id, event_name FROM staged")
def _(x):
    stream = jobs.drop_retries(stage_events(streamed_raw(x)))
    return outcome(x, stream.select(F.col("event_key").alias("event_id"), "user_id", "event_name"), "retries")


@query("st4_streaming_volume", f"""
SELECT event_date, count(*) AS "count" FROM staged GROUP BY 1
HAVING CAST(event_date AS TIMESTAMP) + INTERVAL 1 DAY <= {watermark("1 HOUR")}""")
def _(x):
    return outcome(x, jobs.daily_volume(stage_events(streamed_raw(x)), "1 hour"), "volume")


@query("st5_late_data", f"""
SELECT event_date, count(*) AS "count" FROM staged GROUP BY 1
HAVING CAST(event_date AS TIMESTAMP) + INTERVAL 1 DAY <= {watermark("3 DAY")}""")
def _(x):
    return outcome(x, jobs.daily_volume(stage_events(streamed_raw(x))), "late")


ABANDONED = """
SELECT user_id, event_ts AS cart_ts FROM (
  SELECT *, lead(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts, event_key) AS next_ts FROM (
    SELECT DISTINCT * FROM staged WHERE event_name IN ('product_added_to_cart', 'checkout_completed')))
WHERE event_name = 'product_added_to_cart' AND (next_ts IS NULL OR next_ts > event_ts + INTERVAL 60 MINUTE)"""
ACTIVE = "(SELECT event_ts FROM staged WHERE event_name IN ('product_added_to_cart', 'checkout_completed'))"


@query("st6_abandoned_carts", ABANDONED)
def _(x):
    return carts.abandoned_carts(x.staged())


@query("st6_streaming_abandoned_carts", f"""
SELECT * FROM ({ABANDONED}) WHERE cart_ts + INTERVAL 60 MINUTE <= {watermark("10 MINUTE", ACTIVE)}""")
def _(x):
    return outcome(x, jobs.abandoned_carts(stage_events(streamed_raw(x))), "carts")


# ------------------------------------------------------------- deliveries, one after the other

# Ten days to a delivery.
BLOCK = "least(2, date_diff('day', DATE '2024-01-01', event_date) // 10)"


def block_of_days():
    return F.least(F.lit(2), F.floor(F.datediff("event_date", F.lit("2024-01-01").cast("date")) / 10))


def loaded(x: Inputs, settings: Settings = SQL) -> DayStore:
    """The store after three deliveries, each taken in by a run of its own."""
    store, checkpoint = DayStore(x.spark, shared_folder(x.spark, "store")), shared_folder(x.spark, "load-state")
    for _, stream in x.deliveries(block_of_days(), 3):
        incremental.load_available(store, stream, checkpoint, settings)
    return store


@query("x10_incremental_load", f"SELECT {GOLD} FROM gold")
def _(x):
    return loaded(x).read(incremental.GOLD).drop("event_date")


@query("x10_incremental_load_b", f"SELECT {GOLD} FROM gold_b")
def _(x):
    return loaded(x, PANDAS).read(incremental.GOLD).drop("event_date")


REQUESTS = "SELECT user_id FROM staged WHERE event_name = 'checkout_completed' AND revenue > 200"


def _before_deletion(x: Inputs):
    store = DayStore(x.spark, shared_folder(x.spark, "store"))
    incremental.load_batch(store, x.raw, incremental.STEP)
    bought = (F.col("event_name") == "checkout_completed") & (F.col("revenue") > 200)
    requests = store.read(incremental.EVENTS).where(bought).select("user_id")
    return store, requests


@query("x14_deletion_rewrite", f"""
SELECT 'events' AS name, count(*) AS n FROM staged WHERE user_id NOT IN ({REQUESTS})
UNION ALL SELECT 'gold', count(*) FROM gold WHERE user_id NOT IN ({REQUESTS})
UNION ALL SELECT 'day_users', count(*) FROM (SELECT DISTINCT user_id, event_date FROM staged WHERE user_id NOT IN ({REQUESTS}))""")
def _(x):
    store, requests = _before_deletion(x)
    incremental.delete_users(store, requests, incremental.next_version(store))
    store.vacuum()
    counts = [store.read(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name in ("events", "gold", "day_users")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("x14_deletion_receipt", f"""
SELECT 'events' AS name, count(*) AS rows_removed FROM staged WHERE user_id IN ({REQUESTS})
UNION ALL SELECT 'gold', count(*) FROM gold WHERE user_id IN ({REQUESTS})
UNION ALL SELECT 'day_users', count(*) FROM (SELECT DISTINCT user_id, event_date FROM staged WHERE user_id IN ({REQUESTS}))""")
def _(x):
    store, requests = _before_deletion(x)
    receipt = incremental.delete_users(store, requests, incremental.next_version(store))
    return receipt.where("name <> 'conversion_state'").select("name", "rows_removed")


@query("st1_repeats_across_batches", f"""
SELECT event_date, zone, count(*) AS n FROM (
  SELECT event_date, CASE WHEN {CRITICAL_ROW} OR row_number() OVER (PARTITION BY event_id) > 1
    THEN 'quarantine' ELSE 'clean' END AS zone FROM raw) GROUP BY ALL""")
def _(x):
    # Any split does: a copy in a later delivery is held like one in the same.
    store, checkpoint = DayStore(x.spark, shared_folder(x.spark, "store")), shared_folder(x.spark, "zones-state")
    for _, stream in x.deliveries(F.monotonically_increasing_id() % 3, 3):
        zones.receive_available(store, stream, checkpoint, lateness_days=60)
    return zones.zone_counts(store)


@query("st5_late_zone", f"""
SELECT event_date, zone, count(*) AS n FROM (
  SELECT event_date, CASE WHEN "timestamp" < mark - INTERVAL 3 DAY THEN 'late'
    WHEN {CRITICAL_ROW} OR row_number() OVER (PARTITION BY event_id) > 1 THEN 'quarantine' ELSE 'clean' END AS zone
  FROM (SELECT *, least(2, {BLOCK} + CASE WHEN event_id % 9 = 0 THEN 1 ELSE 0 END) AS part FROM raw) r
  LEFT JOIN (SELECT p.part, max(e."timestamp") AS mark FROM (SELECT unnest([1, 2]) AS part) p JOIN (
    SELECT "timestamp", least(2, {BLOCK} + CASE WHEN event_id % 9 = 0 THEN 1 ELSE 0 END) AS part FROM raw) e ON e.part < p.part GROUP BY 1) m
  ON m.part = r.part) GROUP BY ALL""")
def _(x):
    # Every ninth event comes with the delivery after its own.
    store, checkpoint = DayStore(x.spark, shared_folder(x.spark, "store")), shared_folder(x.spark, "zones-state")
    part = F.least(F.lit(2), block_of_days() + F.when(F.col("event_id") % 9 == 0, 1).otherwise(0))
    for _, stream in x.deliveries(part, 3):
        zones.receive_available(store, stream, checkpoint)
    return zones.zone_counts(store)


def _gated(x: Inputs) -> DayStore:
    store = DayStore(x.spark, shared_folder(x.spark, "store"))
    days = [r[0] for r in x.raw.select("event_date").distinct().collect()]
    gate = zones.Gate(null_rate=0.15, required=("client_id", "page_url"))
    zones.receive_batch(store, x.raw, incremental.STEP, gate=gate, days=days)
    return store


FAILING = """
  SELECT event_date, 'R3_null_identity' AS rule, count(*) FILTER (WHERE coalesce(cid_old, cid_new) IS NULL) AS n, count(*) AS total
  FROM raw GROUP BY 1 HAVING n > 0.15 * total
  UNION ALL SELECT event_date, 'R10_purchase_follows_checkout', count(*) FILTER (WHERE event_name = 'checkout_completed')
    - count(*) FILTER (WHERE event_name = 'checkout_started') AS n, count(*) FROM raw GROUP BY 1 HAVING n > 0"""


@query("x16_ingestion_gate", f"""
SELECT event_date, zone, count(*) AS n FROM (
  SELECT event_date, CASE WHEN {CRITICAL_ROW} OR row_number() OVER (PARTITION BY event_id) > 1
    THEN 'quarantine' ELSE 'clean' END AS zone FROM raw) WHERE event_date NOT IN (SELECT event_date FROM ({FAILING})) GROUP BY ALL""")
def _(x):
    return zones.zone_counts(_gated(x))


@query("x16_held_days", f"SELECT * FROM ({FAILING})")
def _(x):
    return zones.held_days(_gated(x)).drop("severity")


@query("x11_replay_store", f"""
SELECT event_date, zone, count(*) AS n FROM (
  SELECT event_date, CASE WHEN ({LENIENT_ROW}) OR row_number() OVER (PARTITION BY event_id) > 1
    THEN 'quarantine' ELSE 'clean' END AS zone FROM raw) GROUP BY ALL""")
def _(x):
    store = DayStore(x.spark, shared_folder(x.spark, "store"))
    zones.receive_batch(store, x.raw, incremental.STEP)
    for _ in range(2):
        zones.replay_store(store, incremental.next_version(store), LENIENT)
    return zones.zone_counts(store)


@query("st6_cart_timers", f"""
SELECT * FROM ({ABANDONED}) WHERE cart_ts + INTERVAL 60 MINUTE <= {watermark("10 MINUTE", ACTIVE)}""")
def _(x):
    path, checkpoint = shared_folder(x.spark, "timers"), shared_folder(x.spark, "timers-state")
    for _, stream in x.deliveries(block_of_days(), 3):
        cart_timers.run_with_timers(stage_events(stream), path, checkpoint)
    return x.spark.read.schema("user_id string, cart_ts timestamp").parquet(path)
