"""Credit of conversions to the sessions before them.

The lookback is an as-of lookup, not a join of a user's conversions with a user's
sessions: that join would emit every pair of a hot user before the time filter.
Sessions start at least one timeout apart, so a time slice holds at most one start, and
the lookback is a whole number of slices.  Sessions and the distinct slices that hold
conversions are lined up per user, a window over that line (bounded by the covered
period) resolves each slice, and every conversion then meets exactly one resolved row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.config import SQL, Settings
from clickloom.functions.fields import days_before
from clickloom.operators.conversions import conversions as dedupe_conversions
from clickloom.operators.sessions import fold_slices, number_slices, slice_of


def _touch(start: str, first_channel: str, last_channel: str) -> Column:
    return F.struct(
        F.col(start).alias("start"), F.col(first_channel).alias("first_channel"), F.col(last_channel).alias("last_channel")
    )


def _timeline(conversions: DataFrame, sessions: DataFrame, settings: Settings) -> DataFrame:
    """Session starts and conversion slices of each user on one axis of slices."""
    touch = _touch("session_start_ts", "session_first_channel", "session_last_channel")
    starts = sessions.select(
        "user_id",
        slice_of(F.col("session_start_ts"), settings).alias("slice"),
        touch.alias("touch"),
        F.lit(False).alias("wanted"),
    )
    probes = (
        conversions.select("user_id", slice_of(F.col("conversion_ts"), settings).alias("slice"))
        .where(F.col("slice").isNotNull())
        .distinct()
        .select("user_id", "slice", F.lit(None).cast(starts.schema["touch"].dataType).alias("touch"), F.lit(True).alias("wanted"))
    )
    return starts.unionByName(probes)


def slices_with_touches(events: DataFrame, settings: Settings) -> DataFrame:
    """The same axis straight from staged events, without a second pass for the probes.

    The fold that builds sessions already visits every slice with a conversion, so it
    only has to remember that there was one.
    """
    whole = Window.partitionBy("user_id", "session_seq")
    touch = _touch("opening.event_ts", "opening.derived_channel", "last.derived_channel")
    return (
        number_slices(fold_slices(events, settings), settings)
        .withColumn("last", F.max("closing").over(whole))
        .select("user_id", "slice", F.when(F.col("opens"), touch).alias("touch"), F.col("has_conversion").alias("wanted"))
    )


def _resolve(timeline: DataFrame, settings: Settings) -> DataFrame:
    """Per wanted (user, slice): the sessions that can be a first or last touch in it.

    ``here`` starts in the slice itself, ``earlier`` is the last one before it, ``edge``
    starts in the slice the lookback opens in, ``inside`` is the first one after that.
    """
    span = settings.lookback_slices
    line = Window.partitionBy("user_id").orderBy("slice")
    return (
        timeline.select(
            "user_id",
            "slice",
            "wanted",
            F.last("touch", ignorenulls=True).over(line.rangeBetween(Window.unboundedPreceding, -1)).alias("earlier"),
            F.max("touch").over(line.rangeBetween(0, 0)).alias("here"),
            F.max("touch").over(line.rangeBetween(-span, -span)).alias("edge"),
            F.first("touch", ignorenulls=True).over(line.rangeBetween(1 - span, 0)).alias("inside"),
        )
        .where("wanted")
        .drop("wanted")
    )


def before(moment: Column, limit: Column, settings: Settings) -> Column:
    return moment <= limit if settings.include_conversion_start else moment < limit


def _match(conversions: DataFrame, resolved: DataFrame, settings: Settings) -> DataFrame:
    opens = days_before(F.col("conversion_ts"), settings.lookback_days)
    at = F.col("conversion_ts")
    last = F.when(before(F.col("here.start"), at, settings), F.col("here")).otherwise(F.col("earlier"))
    first = F.when(F.col("edge.start") >= opens, F.col("edge")).otherwise(F.col("inside"))
    return (
        conversions.withColumn("slice", slice_of(at, settings))
        .join(resolved, ["user_id", "slice"], "left")
        .withColumns({"last_touch": last, "first_touch": first})
        .withColumns(
            {
                "last_touch": F.when(F.col("last_touch.start") >= opens, F.col("last_touch")),
                "first_touch": F.when(before(F.col("first_touch.start"), at, settings), F.col("first_touch")),
            }
        )
        .drop("slice", "earlier", "here", "edge", "inside")
    )


def match_sessions(conversions: DataFrame, sessions: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Conversions with ``first_touch`` and ``last_touch``, NULL where none is in the window.

    A touch is a struct (start, first_channel, last_channel) of a session that starts
    within the lookback and not after the conversion.
    """
    return _match(conversions, _resolve(_timeline(conversions, sessions, settings), settings), settings)


def match_events(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Conversions of staged events with their touches: two scans, no session table."""
    resolved = _resolve(slices_with_touches(events, settings), settings)
    return _match(dedupe_conversions(events, settings), resolved, settings)


def credit(matched: DataFrame, settings: Settings = SQL) -> DataFrame:
    """First- and last-click channel of matched conversions."""
    last = "last_touch.last_channel" if settings.last_click_from == "last" else "last_touch.first_channel"
    fallback = F.lit(settings.fallback)
    return matched.select(
        "transaction_id",
        "user_id",
        "revenue",
        F.col("conversion_ts").alias("conversion_time"),
        F.coalesce("first_touch.first_channel", fallback).alias("first_click_channel"),
        F.coalesce(last, fallback).alias("last_click_channel"),
    )


def attribute(conversions: DataFrame, sessions: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Gold table from de-duplicated conversions and the session table."""
    return credit(match_sessions(conversions, sessions, settings), settings)


def attribute_events(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Gold table straight from staged events."""
    return credit(match_events(events, settings), settings)
