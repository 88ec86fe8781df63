"""Sessions by inactivity, built so that no user has to fit in one task.

A window over all events of a user puts a crawler or a shared id, which may hold a
large part of all rows, into a single task.  Here events are first folded into time
slices no longer than the timeout.  Two events of one user in one slice are always in
the same session, so the fold is a plain grouped aggregate with map-side combine, and
what is left per user is bounded by the covered period (48 slices a day at 30
minutes), however many events there were.  Only those slices go through a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.config import SQL, Settings
from clickloom.functions.fields import time_slice
from clickloom.operators.normalize import is_conversion


def slice_of(moment: Column, settings: Settings) -> Column:
    return time_slice(moment, settings.slice_length)


def opens_session(moment: Column, previous: Column, settings: Settings = SQL) -> Column:
    """Whether an event opens a session, given the time of the event before it."""
    limit = previous + F.expr(f"INTERVAL {settings.timeout_minutes} MINUTES")
    late = moment >= limit if settings.boundary == "ge" else moment > limit
    return previous.isNull() | late


def fold_slices(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """One row per user and time slice: first and last event, counts.

    ``opening`` and ``closing`` are structs ordered by (time, key), so one minimum and
    one maximum give the bounds of the slice together with the channels at them.
    """
    return (
        events.where(F.col("event_ts").isNotNull())
        .groupBy("user_id", slice_of(F.col("event_ts"), settings).alias("slice"))
        .agg(
            F.min(F.struct("event_ts", "event_key", "derived_channel", "utm_campaign")).alias("opening"),
            F.max(F.struct("event_ts", "event_key", "derived_channel")).alias("closing"),
            F.count(F.lit(1)).alias("row_count"),
            F.count("event_name").alias("named_count"),
            F.coalesce(F.bool_or(is_conversion()), F.lit(False)).alias("has_conversion"),
        )
    )


def number_slices(slices: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Give every slice the running session number of its user and the slice before it."""
    by_time = Window.partitionBy("user_id").orderBy("slice")
    return (
        slices.withColumn("previous_last_ts", F.lag("closing.event_ts").over(by_time))
        .withColumn("opens", opens_session(F.col("opening.event_ts"), F.col("previous_last_ts"), settings))
        .withColumn("session_seq", F.sum(F.col("opens").cast("bigint")).over(
            by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )


def session_id(settings: Settings = SQL) -> Column:
    return F.concat("user_id", F.lit(settings.id_sep), F.col("session_seq").cast("string"))


def build_sessions(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Session facts: bounds, number of events, first and last channel, campaign.

    The last grouping contains ``user_id``, by which the window before it has already
    partitioned, so it costs no shuffle.
    """
    counted = "row_count" if settings.count_events == "rows" else "named_count"
    return (
        number_slices(fold_slices(events, settings), settings)
        .groupBy("user_id", "session_seq")
        .agg(
            F.min("opening").alias("opening"),
            F.max("closing").alias("closing"),
            F.sum(counted).alias("events"),
        )
        .select(
            session_id(settings).alias("session_id"),
            "user_id",
            "session_seq",
            F.col("opening.event_ts").alias("session_start_ts"),
            F.col("closing.event_ts").alias("session_end_ts"),
            "events",
            F.col("opening.derived_channel").alias("session_first_channel"),
            F.col("closing.derived_channel").alias("session_last_channel"),
            F.col("opening.utm_campaign").alias("session_campaign"),
        )
    )


RUN_COLUMNS = (("part", "int"), ("head", "boolean"), ("starts", "boolean"), ("prev_micros", "bigint"), ("opened", "bigint"))


def _gap_opens(settings: Settings):
    limit = settings.timeout_minutes * 60_000_000
    return (lambda gap: gap >= limit) if settings.boundary == "ge" else (lambda gap: gap > limit)


def _in_runs(events: DataFrame, settings: Settings) -> DataFrame:
    """Events sorted by (user, time) over ranges, with what a range alone can tell of each.

    ``head``: of the range's first user, who may have earlier events in other ranges;
    ``starts``: first event of its user here; ``prev_micros``: the event before it here;
    ``opened``: sessions its user has opened here so far, not counting a head's first event.
    """
    order = ["user_id", "event_ts", "event_key"]
    rows = events.where(F.col("event_ts").isNotNull())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    late = _gap_opens(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, user, at, count = TaskContext.get().partitionId(), None, None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            users = batch.column("user_id")
            micros = batch.column("event_ts").cast(pa.int64()).to_numpy()
            own = users[0].as_py()
            if first is None:
                first = (own,)
            starts = np.ones(n, bool)
            code = users.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            starts[1:] = code[1:] != code[:-1]
            starts[0] = user != (own,)
            segment = np.flatnonzero(np.r_[True, starts[1:]])
            size = np.diff(np.r_[segment, n])
            head = np.repeat([users[int(i)].as_py() == first[0] for i in segment], size)
            before = np.r_[at, micros[:-1]]
            opens = np.where(starts, ~head, late(micros - before))
            running = np.cumsum(opens)
            opened = running - np.repeat(running[segment] - opens[segment], size)
            if not starts[0]:
                opened[: size[0]] += count
            user, at, count = (users[n - 1].as_py(),), int(micros[-1]), int(opened[-1])
            columns = [
                pa.array(np.full(n, part, np.int32)), pa.array(head), pa.array(starts),
                pa.array(before, mask=starts), pa.array(opened.astype(np.int64)),
            ]
            for (name, _), column in zip(RUN_COLUMNS, columns, strict=True):
                batch = batch.append_column(name, column)
            yield batch

    schema = T.StructType([*events.schema.fields, *T.StructType.fromDDL(", ".join(map(" ".join, RUN_COLUMNS))).fields])
    return rows.mapInArrow(run, schema)


def flag_session_starts(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Every event with the time of its predecessor, new-session flag, number and id.

    Events are sorted over ranges, so a user with any share of them, even within one
    instant's slice, is spread over tasks.  Only the first user of a range can go on from
    an earlier one: what the ranges before hold of that user, one row for each range at
    most, is summed up and handed to the range.  Both readers of the sorted events share
    one shuffle, and have to: another would draw the ranges elsewhere.
    """
    if events.sparkSession.conf.get("spark.sql.exchange.reuse", "true") != "true":
        raise ValueError("flag_session_starts needs spark.sql.exchange.reuse")
    runs = _in_runs(events, settings)
    last = F.max_by(F.struct("event_ts", "opened"), F.struct("event_ts", "event_key"))
    # Users that go over a range's edge: its first and its last one.
    per_user = runs.groupBy("part", "user_id", "head").agg(F.min("event_ts").alias("first_ts"), last.alias("last"))
    ranked = per_user.groupBy("part").agg(
        F.max_by(F.struct("user_id", "head", "first_ts", "last"), F.struct("head", "user_id")).alias("first_user"),
        F.max_by(F.struct("user_id", "head", "first_ts", "last"), "user_id").alias("last_user"),
    )
    edges = ranked.select("part", F.explode(F.array_distinct(F.array("first_user", "last_user"))).alias("u")).select("part", "u.*")
    line = Window.partitionBy("user_id").orderBy("part")
    before = F.lag("last.event_ts").over(line)
    opens = F.when(F.col("head"), opens_session(F.col("first_ts"), F.col("before_ts"), settings)).otherwise(False).cast("bigint")
    edges = edges.withColumn("before_ts", before).withColumn("first_opens", opens)
    earlier = F.sum(F.col("last.opened") + F.col("first_opens")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    carried = edges.withColumn("base", F.coalesce(earlier, F.lit(0)) + F.col("first_opens")).where("head")
    carried = carried.select(F.col("part").alias("of_part"), F.lit(True).alias("of_head"), "before_ts", "base", "first_opens")
    known = runs.join(carried, [runs["part"] == carried["of_part"], runs["head"] == carried["of_head"]], "left")
    entering = F.col("head") & F.col("starts")
    known = known.withColumns({
        "prev_ts": F.when(entering, F.col("before_ts")).otherwise(F.timestamp_micros("prev_micros")),
        "session_seq": F.col("opened") + F.coalesce("base", F.lit(0)),
    })
    known = known.withColumn("is_new_session", opens_session(F.col("event_ts"), F.col("prev_ts"), settings))
    return known.withColumn("session_id", session_id(settings)).select(
        *[runs[f"`{c}`"] for c in events.columns], "session_seq", "prev_ts", "is_new_session", "session_id"
    )


def session_events(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Every event with its session id.

    One equi-join on (user, slice); no window over events, so a hot slice is split by
    the adaptive skew join like any other.
    """
    numbered = number_slices(fold_slices(events, settings), settings)
    return (
        events.where(F.col("event_ts").isNotNull())
        .withColumn("slice", slice_of(F.col("event_ts"), settings))
        .join(numbered.select("user_id", "slice", "session_seq"), ["user_id", "slice"])
        .select(
            session_id(settings).alias("session_id"),
            "user_id",
            "event_ts",
            "event_name",
            "page_url",
            "derived_channel",
            "utm_source",
            "utm_medium",
            "utm_campaign",
            "revenue",
            "transaction_id",
            "event_key",
        )
    )
