"""The daily run that does not read history: events, conversion state and gold, batch by batch.

Every micro-batch appends its events and its conversions, reduced to one row per
transaction, to a ``DayStore``, and replaces the gold days it changes.  Which those are:

* ``since`` is the batch's earliest event.  A session that runs across it changes too, so
  conversions count again from the start of the earliest such session.
* Their lookback needs the events from one lookback and one timeout before that.  A
  session that begins at the very start of what was read may be longer; then more is read.
* A transaction seen again moves; the day its gold row was on is written again as well.

All is published at once with the new high-water mark, and a batch that is published
already is left alone, so a batch replayed after a crash changes nothing.  Conversions
come from the kept state; of the events only the new days and the overlap are opened.

Defined results: events without a time are kept but not attributed; an empty batch is
published as such.  Repeated rows of different batches are the zones' business
(``streaming.zones``), not this module's.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.config import SQL, Settings
from clickloom.operators.attribution import attribute
from clickloom.operators.conversions import conversions
from clickloom.operators.normalize import CONVERSION_EVENTS, stage_events
from clickloom.operators.sessions import build_sessions
from clickloom.operators.upkeep import conversion_keys, same
from clickloom.sources.day_store import DayStore, Entry

EVENTS, STATE, GOLD, USERS = "events", "conversion_state", "gold", "day_users"
MINUTE, DAY_LENGTH = 60_000_000, 86_400_000_000
# Stream batches take every so many-th version; runs between them (replay, deletion) the ones after.
STEP = 1000


@dataclass(frozen=True)
class Load:
    """What one batch did; times are those of events, in microseconds since 1970."""

    version: int
    since: int | None = None
    credited_from: int | None = None
    read_from: int | None = None
    gold_days: tuple[date, ...] = ()
    opened: tuple[str, ...] = ()  # the event files the gold of this batch was made from


def instant(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def day_before(micros: int) -> date:
    """A day no later than that of a moment, whatever the session's time zone."""
    return datetime.fromtimestamp(micros // 1_000_000, UTC).date() - timedelta(days=1)


def conversion_parts(events: DataFrame, settings: Settings) -> DataFrame:
    """Conversions as events: reducing parts of them again gives the conversions of all."""
    found = conversions(events, settings).withColumnRenamed("conversion_ts", "event_ts")
    if settings.conversion_dedupe == "latest":
        found = found.withColumn("event_key", F.lit(0).cast(events.schema["event_key"].dataType))
    else:
        keys = conversion_keys(settings)
        first = events.where(F.col("revenue") > 0).groupBy(*keys).agg(F.min_by("event_key", F.struct("event_ts", "event_key")).alias("event_key"))
        found = found.alias("c").join(first.alias("f"), same("f", "c", keys)).select("c.*", "f.event_key")
    return found.withColumns({"event_name": F.lit(CONVERSION_EVENTS[0]), "event_date": F.to_date("event_ts")})


def _earliest_changed(known: DataFrame, since: int, settings: Settings) -> int | None:
    """Start of the earliest session that began before a moment and runs across it.

    Such a session has an event within a timeout after the moment; no later ones are read.
    """
    cut = instant(since)
    known = known.where(F.col("event_ts") <= instant(since + settings.timeout_minutes * MINUTE))
    across = build_sessions(known, settings).where((F.col("session_start_ts") < cut) & (F.col("session_end_ts") >= cut))
    return across.agg(F.unix_micros(F.min("session_start_ts"))).first()[0]


def _from(store: DayStore, version: int, moment: int) -> DataFrame:
    """Published events and the batch's own from a moment on; earlier days are not opened."""
    return store.read(EVENTS, since=day_before(moment), plus=version).where(F.col("event_ts") >= instant(moment))


def load_batch(store: DayStore, raw: DataFrame, version: int, settings: Settings = SQL) -> Load | None:
    """Take in one batch of raw events; None if it is published already."""
    if version in store.versions():
        return None
    days = store.stage(EVENTS, stage_events(raw, settings), version)
    own = store.staged(EVENTS, version, days)
    since, until = own.agg(F.unix_micros(F.min("event_ts")), F.unix_micros(F.max("event_ts"))).first()
    entries = [Entry(EVENTS, d) for d in days]
    if since is None:
        store.publish(version, entries, json.dumps({}))
        return Load(version)
    entries += [Entry(STATE, d) for d in store.stage(STATE, conversion_parts(own, settings), version)]
    entries += [Entry(USERS, d) for d in store.stage(USERS, own.select("user_id", "event_date").distinct(), version)]

    reach = settings.lookback_days * DAY_LENGTH + settings.timeout_minutes * MINUTE
    start = since - reach
    known_days = [d for d in store.days(EVENTS) if d is not None]
    while True:
        older = any(d < day_before(start) for d in known_days)
        # Only published events can have begun a session before the batch's earliest one.
        near = any(d >= day_before(start) for d in known_days)
        changed = _earliest_changed(_from(store, version, start), since, settings) if near else None
        if changed is None or changed >= start + settings.timeout_minutes * MINUTE or not older:
            break
        start -= reach  # the session may have begun before what was read
    changed = since if changed is None else changed
    recent = _from(store, version, changed - reach)

    keys = conversion_keys(settings)
    state = store.read(STATE, plus=version)
    near = store.read(STATE, since=day_before(changed), plus=version).select(*keys).distinct()
    touched = state.alias("s").join(near.alias("n"), same("n", "s", keys), "left_semi")
    # Read up to three times below.
    credited = conversions(touched, settings).where(F.col("conversion_ts") >= instant(changed)).persist()
    fresh = attribute(credited, build_sessions(recent, settings), settings).withColumn("event_date", F.to_date("conversion_time"))

    gold_days = {d for d in store.days(GOLD) if d is not None and d >= day_before(changed)}
    before = store.read(STATE)
    if before is not None:
        again = before.alias("s").join(credited.select(*keys).alias("c"), same("c", "s", keys), "left_semi")
        moved = conversions(again, settings).where(F.col("conversion_ts") < instant(changed))
        gold_days |= {r[0] for r in moved.select(F.to_date("conversion_ts")).distinct().collect()}
    gold, kept = fresh, store.read(GOLD, days=gold_days)
    if kept is not None:
        kept = kept.where(F.col("conversion_time") < instant(changed))
        kept = kept.alias("g").join(credited.select(*keys).alias("f"), same("g", "f", keys), "left_anti")
        gold = kept.unionByName(fresh)
    gold_days |= set(store.stage(GOLD, gold, version))
    credited.unpersist()
    entries += [Entry(GOLD, d, replaces=True) for d in gold_days]

    mark = max(until, high_water(store) or until)
    store.publish(version, entries, json.dumps({"high_water": mark}))
    opened = tuple(sorted(recent.inputFiles()))
    return Load(version, since, changed, changed - reach, tuple(sorted(d for d in gold_days if d)), opened)


def high_water(store: DayStore) -> int | None:
    """The latest event time of all published batches, in microseconds since 1970."""
    marks = [json.loads(note).get("high_water") for note in store.versions().values() if note]
    return max((m for m in marks if m is not None), default=None)


def load_available(store: DayStore, raw: DataFrame, checkpoint: str, settings: Settings = SQL) -> None:
    """Take in everything a stream of raw events can give now, then stop."""

    def batch(df: DataFrame, version: int) -> None:
        load_batch(store, df, (version + 1) * STEP, settings)

    query = raw.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def next_version(store: DayStore) -> int:
    """A version for a run between two batches of the stream."""
    return max(store.versions(), default=0) + 1


def delete_users(store: DayStore, requests: DataFrame, version: int) -> DataFrame | None:
    """Rewrite the days that hold a listed user, in every table, and no others; returns the receipt, None if there are none.

    Which days these are comes from the kept summary of each day's users, so nothing else
    is opened.  The receipt, published with the rewritten days, says how many rows of a
    table went.  ``store.vacuum()`` then removes the old files for good.
    """
    listed = requests.select("user_id").distinct()
    users = store.read(USERS)
    if users is None:
        return None
    days = [r[0] for r in users.join(listed, "user_id", "left_semi").select("event_date").distinct().collect()]
    if not days:
        return None
    entries, receipt = [], []
    marked = listed.withColumn("hit", F.lit(True))
    for name in (EVENTS, STATE, GOLD, USERS):
        here = days
        if name in (STATE, GOLD):  # these hold a conversion on its own day, which is one of the user's days
            here = [d for d in days if d in store.days(name)]
        rows = store.read(name, days=here)
        if rows is None or not here:
            continue
        watch = Observation()
        gone = F.coalesce(F.sum(F.when(F.col("hit"), 1).otherwise(0)), F.lit(0)).alias("gone")
        kept = rows.join(marked, "user_id", "left").observe(watch, gone).where("hit IS NULL").select(*rows.columns)
        store.stage(name, kept, version)
        entries += [Entry(name, d, replaces=True) for d in here]
        receipt.append((name, watch.get["gone"], len(here), None))
    table = store.spark.createDataFrame(receipt, "name string, rows_removed long, days_rewritten long, event_date date")
    entries += [Entry("receipts", d) for d in store.stage("receipts", table, version)]
    store.publish(version, entries, "")
    return store.staged("receipts", version, [None])
