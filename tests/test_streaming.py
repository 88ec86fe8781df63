import pandas as pd
import pyarrow as pa
from builders import clock, raw_row

from clickloom import PANDAS, SQL
from clickloom.operators.carts import abandoned_carts
from clickloom.operators.normalize import stage_events
from clickloom.operators.sessions import build_sessions
from clickloom.plans.sample_events import as_raw, events_stream, raw_events
from clickloom.streaming import cart_timers, jobs


def test_streamed_sessions_are_batch_sessions(spark, sf_dir, tmp_path):
    columns = ["user_id", "session_start_ts", "session_end_ts", "events", "session_first_channel", "session_last_channel"]
    stream = jobs.sessions(stage_events(as_raw(events_stream(spark, sf_dir))), lateness="1 hour").select(*columns)
    jobs.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    streamed = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    batch = build_sessions(stage_events(raw_events(spark, sf_dir))).select(*columns)
    assert streamed.exceptAll(batch).count() == 0
    assert 0 < batch.exceptAll(streamed).count() < 20


def test_session_window_boundary(spark, tmp_path):
    rows = [raw_row("u", clock()), raw_row("u", clock(minutes=30)), raw_row("late", clock(days=2))]
    source = str(tmp_path / "in")
    schema = "client_id string, clientId string, timestamp string, event_name string, page_url string, referrer string, event_data string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    for name, settings, expected in (("ge", SQL, [1, 1]), ("gt", PANDAS, [2])):
        staged = stage_events(spark.readStream.schema(schema).parquet(source), settings)
        stream = jobs.sessions(staged, settings, "1 hour")
        jobs.run_available(stream, str(tmp_path / name), str(tmp_path / f"{name}-state"))
        out = spark.read.schema(stream.schema).parquet(str(tmp_path / name)).where("user_id = 'u'")
        assert sorted(r.events for r in out.collect()) == expected


def test_restart_reads_nothing_twice(spark, sf_dir, tmp_path):
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        stream = jobs.drop_retries(stage_events(as_raw(events_stream(spark, sf_dir)))).select("event_key")
        jobs.run_available(stream, path, state)
    out = spark.read.parquet(path)
    assert out.count() == out.distinct().count() > 0


def carts(spark, sf_dir, low, high):
    return raw_events(spark, sf_dir).where(f"event_date >= '{low}' AND event_date < '{high}'")


def test_cart_timers_over_restarts(spark, sf_dir, tmp_path):
    landing, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    events = raw_events(spark, sf_dir)
    totals = []
    for low, high in (("2024-01-01", "2024-01-09"), ("2024-01-09", "2024-01-21"), ("2024-01-21", "2024-03-01")):
        carts(spark, sf_dir, low, high).write.mode("append").parquet(landing)
        cart_timers.run_with_timers(stage_events(spark.readStream.schema(events.schema).parquet(landing)), out, state)
        totals.append(spark.read.parquet(out).count())
    found = spark.read.parquet(out)
    batch = abandoned_carts(stage_events(events))
    assert 0 < totals[0] < totals[1] < totals[2]
    assert found.exceptAll(batch).count() == 0
    # What is missing is not decided yet: within the wait of the watermark.
    assert batch.exceptAll(found).count() <= 3


def test_cart_timers_take_events_in_any_order(spark, tmp_path):
    cart = lambda user, **at: raw_row(user, clock(**at), "product_added_to_cart")
    buy = lambda user, **at: raw_row(user, clock(**at), "purchase")
    parts = [
        [cart("a"), cart("b"), cart("c", minutes=50), cart("d")],
        [buy("a", minutes=60), cart("c", minutes=5), buy("d", minutes=5)],  # cleared in time, earlier than what is known
        [cart("z", hours=9)],
    ]
    landing, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "client_id string, clientId string, timestamp string, event_name string, page_url string, referrer string, event_data string"
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        cart_timers.run_with_timers(stage_events(spark.readStream.schema(schema).parquet(landing)), out, state, lateness="1 hour")
    found = sorted((r.user_id, r.cart_ts.hour, r.cart_ts.minute) for r in spark.read.parquet(out).collect())
    assert found == [("b", 0, 0), ("c", 0, 50)]


class FakeState:
    """A bucket's value and timers, counting the calls."""

    value, calls = None, 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return 2 * 3_600_000


def test_users_of_a_bucket_share_the_calls_on_its_state():
    hour, n, state = 3_600_000_000, 500, FakeState()
    timers = cart_timers.CartTimers(hour)
    timers.init(state)
    users = [f"u{i}" for i in range(n)]
    frame = pd.DataFrame({"user_id": users, "micros": range(n), "is_cart": True, "event_key": range(n)})
    # Every second user buys a quarter of an hour later, u1 puts something in the cart when the watermark stands.
    bought = frame[::2].assign(micros=hour // 4, is_cart=False)
    again = frame[1:2].assign(micros=2 * hour)
    for _ in timers.handleInputRows((0,), iter([frame, bought]), state):
        pass
    for _ in timers.handleInputRows((0,), iter([again]), state):
        pass
    found = pd.concat(timers.handleExpiredTimer((0,), state, None))
    assert sorted(found["user_id"]) == sorted(users[1::2])
    assert state.calls <= 10
    assert pa.ipc.open_stream(state.value[0]).read_all().column("user_id").to_pylist() == ["u1"]
