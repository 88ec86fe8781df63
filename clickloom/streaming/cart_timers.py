"""Abandoned carts by event-time timers: a cart opens one, the next event in time clears it, expiry reports it.

Users are dealt into buckets by hash, and a bucket is one key of the state: all its users
are folded and decided together, as columns, so that the cost of a call and of a timer is
shared by them.  The state of a bucket is one entry per user and hour of activity that is
not decided yet: first and last event and whether the last is a cart event.  Inside such
a slice only the last event can be abandoned, and to earlier events only the first one
matters, so the state of a user, however active, is bounded by the wait and the lateness.
Events may come in any order until the watermark has passed; an event that comes late, but
not behind the watermark, takes its place among the others and opens or clears what it
should.  A bucket has a timer for the earliest of its slices; what is over by then is
decided, and the timer is set anew.

The number of buckets belongs to a checkpoint.  A bucket is held whole by a task, a
256th of the users with undecided carts by default.

Needs the RocksDB state store; ``abandoned_by_timer`` sets it for the session it is given,
``run_with_timers`` puts the earlier setting back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.operators.carts import WAIT_MINUTES, cart_activity
from clickloom.streaming.jobs import run_available, watermarked

BUCKETS = 256
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "user_id string, cart_micros long"
SLICE = ["user_id", "slice"]
SLICES = pa.schema([("user_id", pa.string()), *[(n, pa.int64()) for n in ("slice", "first", "last", "last_key")], ("cart", pa.bool_())])
# Instead of a missing key: before all others, as Spark orders them.
NO_KEY = -(1 << 63)


def folded(slices: pd.DataFrame) -> pd.DataFrame:
    """One row per user and slice, in order: first event, and last with its key and whether it is a cart event."""
    slices = slices.sort_values([*SLICE, "last", "last_key", "cart"], ignore_index=True)
    first = slices.groupby(SLICE, sort=False)["first"].transform("min")
    return slices.assign(first=first).drop_duplicates(SLICE, keep="last", ignore_index=True)


class CartTimers(StatefulProcessor):
    def __init__(self, wait: int) -> None:
        self.wait = wait  # microseconds; also the length of a slice

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Undecided slices of the bucket's users, as an Arrow stream.
        self.open = handle.getValueState("open", "slices binary")

    def known(self) -> list[pd.DataFrame]:
        if not self.open.exists():
            return []
        return [pa.ipc.open_stream(self.open.get()[0]).read_pandas()]

    def keep(self, slices: pd.DataFrame) -> None:
        """Hold what is undecided until its earliest slice is over."""
        if slices.empty:
            self.open.clear()
            return
        table = pa.Table.from_pandas(slices, SLICES, preserve_index=False).replace_schema_metadata()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, SLICES) as out:
            out.write_table(table)
        self.open.update((sink.getvalue().to_pybytes(),))
        # Whatever ends a slice is decided when a wait has passed.
        self.handle.registerTimer(-(-(int(slices["last"].min()) + self.wait) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = self.known()
        for batch in rows:
            at = batch["micros"]
            own = {"slice": at // self.wait, "first": at, "last": at, "last_key": batch["event_key"], "cart": batch["is_cart"]}
            parts.append(folded(pd.DataFrame({"user_id": batch["user_id"], **own})))
        self.keep(folded(pd.concat(parts)))
        yield pd.DataFrame({"user_id": pd.Series([], dtype=object), "cart_micros": pd.Series([], dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        for slices in self.known():
            over = slices["last"] + self.wait
            next_user, follows = slices["user_id"].shift(-1), slices["first"].shift(-1, fill_value=0)
            alone = (next_user != slices["user_id"]) | (follows > over)
            decided = over <= now
            if decided.any():
                self.keep(slices[~decided])
            found = slices[decided & slices["cart"] & alone]
            yield pd.DataFrame({"user_id": found["user_id"], "cart_micros": found["last"]})


def abandoned_by_timer(
    staged: DataFrame, wait_minutes: int = WAIT_MINUTES, lateness: str = "10 minutes", buckets: int = BUCKETS
) -> DataFrame:
    """(user_id, cart_ts) of a stream of staged events, as soon as the watermark has passed the wait."""
    staged.sparkSession.conf.set(STORE, ROCKSDB)
    events = watermarked(cart_activity(staged), lateness=lateness).where(F.col("event_ts").isNotNull()).select(
        F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("bucket"), "user_id", "event_ts",
        F.unix_micros("event_ts").alias("micros"), "is_cart",
        F.coalesce(F.col("event_key").cast("long"), F.lit(NO_KEY)).alias("event_key"),
    )
    found = events.groupBy("bucket").transformWithStateInPandas(
        CartTimers(wait_minutes * 60_000_000), OUT, "Append", "EventTime"
    )
    return found.select("user_id", F.timestamp_micros("cart_micros").alias("cart_ts"))


def run_with_timers(staged: DataFrame, path: str, checkpoint: str, **options) -> None:
    """Append the carts a stream of staged events can tell now to a Parquet folder, then stop."""
    conf = staged.sparkSession.conf
    before = conf.get(STORE, None)
    try:
        run_available(abandoned_by_timer(staged, **options), path, checkpoint)
    finally:
        if before is None:
            conf.unset(STORE)
        else:
            conf.set(STORE, before)
