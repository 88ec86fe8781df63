from datetime import date

import pytest
from builders import clock, raw, raw_row
from pyspark.sql import functions as F

from clickloom.operators.contract import Contract, EventRule
from clickloom.plans.sample_events import raw_events
from clickloom.sources.day_store import DayStore
from clickloom.sources.quarantine import route
from clickloom.streaming import zones
from clickloom.streaming.incremental import STEP, next_version

CART = Contract(event_rules={"cart": EventRule(("item",)), "page_view": EventRule(may_be_empty=True)})
LENIENT = Contract(event_rules={"cart": EventRule(("price",)), "page_view": EventRule(may_be_empty=True)})


def arriving(spark, rows):
    return raw(spark, rows).withColumn("event_date", F.to_date("timestamp"))


def counts(df):
    return {(str(r.event_date), r.zone): r.n for r in df.collect()}


def test_repeats_across_batches_are_those_of_one_pass(spark, sf_dir, tmp_path):
    store, events = DayStore(spark, str(tmp_path / "store")), raw_events(spark, sf_dir)
    events = events.withColumn("part", F.monotonically_increasing_id() % 3)  # copies land in different batches
    events.write.parquet(str(tmp_path / "in"))
    for i in range(3):
        part = spark.read.parquet(str(tmp_path / "in")).where(F.col("part") == i).drop("part")
        zones.receive_batch(store, part, (i + 1) * STEP, lateness_days=60)
        assert zones.receive_batch(store, part, (i + 1) * STEP, lateness_days=60) is None
    routed = route(raw_events(spark, sf_dir)).groupBy("event_date", "zone").agg(F.sum("rows").alias("n"))
    assert counts(zones.zone_counts(store)) == counts(routed)


def test_stream_restarted_between_deliveries(spark, tmp_path):
    landing, store = str(tmp_path / "in"), DayStore(spark, str(tmp_path / "store"))
    row = raw_row("u", clock(), payload='{"a":1}')
    for rows in ([row, row], [row, raw_row("v", clock(hours=1))], [row]):
        events = arriving(spark, rows)
        events.coalesce(1).write.mode("append").parquet(landing)
        zones.receive_available(store, spark.readStream.schema(events.schema).parquet(landing), str(tmp_path / "state"))
    assert counts(zones.zone_counts(store)) == {("2025-01-01", "clean"): 2, ("2025-01-01", "quarantine"): 3}


def test_late_rows_are_kept_with_the_watermark_they_missed(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    days = [[0, 5], [1, 2, 3, 4], [9, 5, 6], [0, 8]]
    expected_late = [0, 1, 0, 1]  # behind the latest time so far minus three days
    for i, part in enumerate(days):
        rows = [raw_row(f"u{i}{d}", clock(days=d)) for d in part]
        zones.receive_batch(store, arriving(spark, [*rows, rows[0]]), (i + 1) * STEP)
    stored = store.read("zones")
    late = sorted((r.client_id, r.rows) for r in stored.where("zone = 'late'").groupBy("client_id").agg(F.sum("rows").alias("rows")).collect())
    assert late == [("u11", 2), ("u30", 2)] and len(late) == sum(expected_late)
    assert stored.where("zone = 'late' AND missed IS NULL").count() == 0
    assert stored.agg(F.sum("rows")).first()[0] == sum(len(p) + 1 for p in days)


def test_a_crash_publishes_nothing(spark, tmp_path, monkeypatch):
    store, rows = DayStore(spark, str(tmp_path / "store")), [raw_row("u", clock())]

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DayStore, "publish", crash)
        with pytest.raises(RuntimeError):
            zones.receive_batch(store, arriving(spark, rows), STEP)
    assert DayStore(spark, str(tmp_path / "store")).read("zones") is None
    zones.receive_batch(store, arriving(spark, rows), STEP)
    assert counts(zones.zone_counts(store)) == {("2025-01-01", "clean"): 1}


def test_gate_holds_a_day_back(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    good = [raw_row(f"u{i}", clock(hours=i)) for i in range(4)] + [raw_row(None, clock(hours=5))]
    bad = [raw_row(None if i < 2 else f"u{i}", clock(days=1, hours=i)) for i in range(5)]
    late_buy = [raw_row("x", clock(days=2), "checkout_completed", payload='{"transaction_id":"T","revenue":3}')]
    days = [date(2025, 1, d) for d in (1, 2, 3)]
    held = zones.receive_batch(store, arriving(spark, good + bad + late_buy), STEP, gate=zones.Gate(), days=days)
    assert held == {days[1]: [("R3_null_identity", 2)], days[2]: [("R10_purchase_follows_checkout", 1)]}
    assert set(store.days("zones")) == {days[0]}  # exactly 20 % is not above it
    found = sorted((r.rule, r.n, r.total, r.event_date) for r in zones.held_days(store).collect())
    assert found == [("R10_purchase_follows_checkout", 1, 1, days[2]), ("R3_null_identity", 2, 5, days[1])]
    # Delivered again in order, the day is taken in: its first delivery left no trace in the state.
    again = [raw_row(f"u{i}", clock(days=1, hours=i)) for i in range(5)]
    assert zones.receive_batch(store, arriving(spark, again), 2 * STEP, gate=zones.Gate(), days=days[1:2]) == {}
    assert counts(zones.zone_counts(store))["2025-01-02", "clean"] == 5


def test_gate_reads_its_input_once(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    rows = [raw_row(f"u{i}", clock(hours=i)) for i in range(4)]
    events = arriving(spark, rows).coalesce(1)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    counted = events.mapInPandas(count, events.schema)
    zones.receive_batch(store, counted, STEP, gate=zones.Gate(required=("client_id",)), days=[date(2025, 1, 1)])
    assert seen.value == 4


def test_replay_moves_rows_once(spark, tmp_path, monkeypatch):
    store = DayStore(spark, str(tmp_path / "store"))
    rows = [raw_row("u", clock(), "cart", payload='{"price":1}'), raw_row("v", clock(), "cart", payload="{}"), raw_row("w", clock(days=1))]
    rows += rows[:1]
    zones.receive_batch(store, arriving(spark, rows), STEP, CART)
    assert counts(zones.zone_counts(store)) == {("2025-01-01", "quarantine"): 3, ("2025-01-02", "clean"): 1}
    untouched = set(store.read("zones", days=[date(2025, 1, 2)]).inputFiles())

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DayStore, "publish", crash)
        with pytest.raises(RuntimeError):
            zones.replay_store(store, next_version(store), LENIENT)
    assert counts(zones.zone_counts(store))["2025-01-01", "quarantine"] == 3
    assert zones.replay_store(store, next_version(store), LENIENT) == 1
    assert counts(zones.zone_counts(store)) == {("2025-01-01", "clean"): 1, ("2025-01-01", "quarantine"): 2, ("2025-01-02", "clean"): 1}
    assert set(store.read("zones", days=[date(2025, 1, 2)]).inputFiles()) == untouched
    promoted = []
    for _ in range(7):  # the row that can't be repaired is tried five times in all
        promoted.append(zones.replay_store(store, next_version(store), LENIENT))
    assert promoted == [0] * 7 and len(store.versions()) == 6
    # A batch after the replays is added to what they left; the copy is known.
    zones.receive_batch(store, arriving(spark, rows[:1]), 2 * STEP, LENIENT)
    assert counts(zones.zone_counts(store))["2025-01-01", "quarantine"] == 3
