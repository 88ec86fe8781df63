"""An ordered funnel in one shuffle of the events, whatever the number of steps.

Events are sorted by (user, time) over ranges, so a user of any size is spread over
tasks.  What a range does to a user who comes in with s steps taken is a number, the
steps taken at its end; the range's summary is that function, as an array over s.  Events
of one user and instant are always in one range, so a step must come strictly later than
the one before also across ranges.  Summaries of a user's ranges, at most one for each
range, are then applied one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Walk:
    """How far one gets from every number of steps taken before, along events in order of time."""

    def __init__(self, steps: int) -> None:
        self.taken, self.at = list(range(steps + 1)), [None] * (steps + 1)

    def add(self, step: int, moment: int) -> None:
        """An event of step number ``step`` (from 1)."""
        for s in range(step):  # from s >= step on it changes nothing
            if self.taken[s] == step - 1 and self.at[s] != moment:
                self.taken[s], self.at[s] = step, moment


def summaries(events: DataFrame, steps: tuple[str, ...]) -> DataFrame:
    """(user_id, part, taken): of every user and range the steps taken at its end, by steps taken before it."""
    number = F.create_map(*[x for i, s in enumerate(steps, 1) for x in (F.lit(s), F.lit(i))])[F.col("event_name")]
    rows = events.where(F.col("event_ts").isNotNull() & F.col("user_id").isNotNull() & F.col("event_name").isin(*steps))
    rows = rows.select("user_id", F.unix_micros("event_ts").alias("at"), number.alias("step"))
    rows = rows.repartitionByRange("user_id", "at").sortWithinPartitions("user_id", "at")
    kind = events.schema["user_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, user, walk, done = TaskContext.get().partitionId(), None, None, []

        def out() -> pa.RecordBatch:
            users, taken = [u for u, _ in done], [t for _, t in done]
            return pa.RecordBatch.from_arrays(
                [pa.array(users, type_of), pa.array([part] * len(done), pa.int32()), pa.array(taken, pa.list_(pa.int32()))],
                names=["user_id", "part", "taken"],
            )

        type_of = None
        for batch in batches:
            type_of = batch.schema.field("user_id").type
            for own, at, step in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if walk is None or own != user:
                    if walk is not None:
                        done.append((user, walk.taken))
                    user, walk = own, Walk(len(steps))
                    if len(done) >= 10_000:
                        yield out()
                        done.clear()
                walk.add(step, at)
        if walk is not None:
            done.append((user, walk.taken))
            yield out()

    return rows.mapInArrow(run, f"user_id {kind}, part int, taken array<int>")


def steps_taken(events: DataFrame, steps: tuple[str, ...]) -> DataFrame:
    """(user_id, taken): how many of the steps each user took in this order, for users with an event of any step."""
    ranges = summaries(events, steps).groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("part", "taken"))).alias("ranges"))
    walked = F.aggregate("ranges", F.lit(0), lambda s, r: F.element_at(r["taken"], s + 1))
    return ranges.select("user_id", walked.alias("taken"))


def ordered_funnel(events: DataFrame, steps: tuple[str, ...]) -> DataFrame:
    """(position, step, users): users who took the steps in this order, each strictly later than the one before."""
    reached = steps_taken(events, steps).agg(*[F.count_if(F.col("taken") >= i).alias(f"n{i}") for i in range(1, len(steps) + 1)])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(s).alias("step"), F.col(f"n{i}").alias("users")) for i, s in enumerate(steps, 1)
    ]
    return reached.select(F.inline(F.array(*rows)))
