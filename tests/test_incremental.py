import pytest
from builders import clock, purchase, raw, raw_row
from pyspark.sql import functions as F

from clickloom import SQL
from clickloom.config import Settings
from clickloom.operators.attribution import attribute_events
from clickloom.operators.normalize import stage_events
from clickloom.plans.sample_events import raw_events
from clickloom.sources.day_store import DayStore, Entry
from clickloom.streaming import incremental as inc

GOOGLE, MAIL = "https://google.com", "?utm_medium=email"
EARLIEST = Settings(conversion_dedupe="earliest")


def gold(df):
    columns = ("transaction_id", "user_id", "revenue", "conversion_time", "first_click_channel", "last_click_channel")
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def deliveries(spark):
    """Three deliveries: a session across a cut, a bot without end, a transaction bought again, a late event."""
    bot = [raw_row("bot", clock(minutes=20 * i), referrer=GOOGLE) for i in range(24 * 72)]
    first = [*bot[: 10 * 72], raw_row("a", clock(days=9, hours=23, minutes=50), referrer=GOOGLE),
             purchase("a", clock(days=9, hours=23, minutes=55), "T1", 10), purchase("b", clock(days=3), "T2", 5),
             purchase("c", clock(days=2), None, 1), purchase("bot", clock(days=1, minutes=1), "B", 1)]
    second = [*bot[10 * 72 : 20 * 72], raw_row("a", clock(days=10, minutes=2), path=MAIL),
              purchase("b", clock(days=12), "T2", 4), purchase("d", clock(days=15), "T1", 3)]
    third = [*bot[20 * 72 :], raw_row("d", clock(days=14, hours=20), path=MAIL), purchase("e", clock(days=23), "T5", 2),
             purchase("b", clock(days=20), "T2", 9)]
    return [first, second, third]


@pytest.mark.parametrize("settings", [SQL, EARLIEST])
def test_gold_of_batches_is_gold_of_all(spark, tmp_path, settings):
    store, parts, loads = DayStore(spark, str(tmp_path / "store")), deliveries(spark), []
    for i, rows in enumerate(parts):
        loads.append(inc.load_batch(store, raw(spark, rows), (i + 1) * inc.STEP, settings))
        so_far = raw(spark, [r for p in parts[: i + 1] for r in p])
        assert gold(store.read("gold")) == gold(attribute_events(stage_events(so_far, settings), settings))
    assert inc.load_batch(store, raw(spark, parts[2]), 3 * inc.STEP, settings) is None
    assert store.read("events").count() == sum(map(len, parts))


def test_later_runs_open_the_overlap_only(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    for i, days in enumerate((range(20), range(20, 22))):
        rows = [raw_row(f"u{u}", clock(days=d, hours=u), referrer=GOOGLE) for d in days for u in range(3)]
        load = inc.load_batch(store, raw(spark, [*rows, purchase("u1", clock(days=days[0], hours=2), f"T{i}", 1)]), (i + 1) * inc.STEP)
    opened = {f.split("event_date=")[1][:10] for f in load.opened}
    assert min(opened) >= "2025-01-12" and "2025-01-21" in opened  # seven days, a timeout, and the margin of a day
    assert len(store.days("events")) == 22


def test_a_crash_before_publishing_changes_nothing(spark, tmp_path, monkeypatch):
    parts = deliveries(spark)
    store = DayStore(spark, str(tmp_path / "store"))
    inc.load_batch(store, raw(spark, parts[0]), inc.STEP)
    before = gold(store.read("gold"))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DayStore, "publish", crash)
        with pytest.raises(RuntimeError):
            inc.load_batch(store, raw(spark, parts[1]), 2 * inc.STEP)
    store = DayStore(spark, str(tmp_path / "store"))  # another driver
    assert gold(store.read("gold")) == before and inc.high_water(store) is not None
    inc.load_batch(store, raw(spark, parts[1]), 2 * inc.STEP)
    assert gold(store.read("gold")) == gold(attribute_events(stage_events(raw(spark, parts[0] + parts[1]))))


def test_stream_of_deliveries(spark, sf_dir, tmp_path):
    landing, store = str(tmp_path / "in"), DayStore(spark, str(tmp_path / "store"))
    events = raw_events(spark, sf_dir)
    for low, high in (("2024-01-01", "2024-01-13"), ("2024-01-13", "2024-02-20")):
        events.where(f"event_date >= '{low}' AND event_date < '{high}'").write.mode("append").parquet(landing)
        inc.load_available(store, spark.readStream.schema(events.schema).parquet(landing), str(tmp_path / "state"))
        inc.load_available(store, spark.readStream.schema(events.schema).parquet(landing), str(tmp_path / "state"))
    assert sorted(store.versions()) == [inc.STEP, 2 * inc.STEP]
    assert gold(store.read("gold")) == gold(attribute_events(stage_events(events)))


def test_deletion_rewrites_only_the_days_of_listed_users(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    rows = [raw_row("a", clock(days=d)) for d in range(6)] + [purchase("b", clock(days=2), "T1", 1), purchase("a", clock(days=2), "T2", 1)]
    inc.load_batch(store, raw(spark, rows), inc.STEP)
    untouched = {d: set(store.read("events", days=[d]).inputFiles()) for d in store.days("events")}
    requests = spark.createDataFrame([("b",), ("nobody",)], "user_id string")
    receipt = {r.name: r.rows_removed for r in inc.delete_users(store, requests, inc.next_version(store)).collect()}
    assert receipt == {"events": 1, "conversion_state": 1, "gold": 1, "day_users": 1}
    changed = [d for d, files in untouched.items() if set(store.read("events", days=[d]).inputFiles()) != files]
    assert [str(d) for d in changed] == ["2025-01-03"]
    assert len(store.vacuum()) == 4
    assert all("b" not in path.read_text(errors="replace") for path in tmp_path.rglob("nothing"))
    for name in ("events", "conversion_state", "gold", "day_users"):
        assert store.read(name).where("user_id = 'b'").count() == 0
    on_disk = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "store" / "events"))
    assert on_disk.where("user_id = 'b'").count() == 0 and on_disk.count() == 7
    assert inc.delete_users(store, requests, inc.next_version(store)) is None


def test_a_day_replaced_by_nothing_is_empty(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    rows = spark.range(3).withColumn("event_date", F.lit("2025-01-01").cast("date"))
    days = store.stage("t", rows, 1)
    store.publish(1, [Entry("t", d) for d in days])
    store.stage("t", rows.limit(0), 2)
    store.publish(2, [Entry("t", days[0], replaces=True)])
    assert store.read("t").count() == 0 and store.read("other") is None
    store.stage("t", rows, 3)
    store.publish(3, [Entry("t", days[0])])
    assert store.read("t").count() == 3


def test_empty_batch(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "store"))
    assert inc.load_batch(store, raw(spark, []), inc.STEP).since is None
    assert inc.STEP in store.versions()


def test_sessions_across_a_cut_are_sought_near_it(spark, tmp_path, monkeypatch):
    """The search folded the whole batch once more, and the first batch for nothing."""
    seen, build = [], inc.build_sessions

    def watched(events, settings):
        seen.append(events.agg(F.unix_micros(F.max("event_ts"))).first()[0])
        return build(events, settings)

    monkeypatch.setattr(inc, "build_sessions", watched)
    store = DayStore(spark, str(tmp_path / "store"))
    first = [raw_row("a", clock(hours=23, minutes=50)), raw_row("b", clock(hours=1))]
    second = [raw_row("a", clock(days=1, minutes=5)), raw_row("b", clock(days=3)), raw_row("a", clock(days=1, minutes=35))]
    inc.load_batch(store, raw(spark, first), inc.STEP)
    assert len(seen) == 1
    load = inc.load_batch(store, raw(spark, second), 2 * inc.STEP)
    assert len(seen) == 3 and load.since <= seen[1] <= load.since + SQL.timeout_minutes * inc.MINUTE < seen[2]
    assert load.credited_from == load.since - 15 * inc.MINUTE
