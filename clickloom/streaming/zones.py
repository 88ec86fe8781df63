"""Raw events as they arrive: clean, quarantine or late, repeats found across batches.

One micro-batch is read once and written once:

* Rows are counted by grouping on the row itself, which merges copies before the shuffle.
* The watermark is the latest time of all *published* batches minus the allowed lateness.
  A row behind it is late: kept in a zone of its own with the watermark it missed.
* Hashes of rows taken in so far are kept per day.  Only days at or after the watermark
  can meet them again, so the state that is read is bounded by the lateness; a row that
  was seen before is held as a repeat.
* Whether a day may be published at all is decided from metrics observed during that same
  write.  A day that fails stays staged, unseen by readers, and its finding is written.

All tables of a batch are published at once (``DayStore``): a crash leaves nothing half
done, and a batch that is published already is left alone.

Defined results: rows without a parseable time are never late and belong to no day; with
``seen`` hashes of 128 bits two different rows count as copies with negligible probability.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.functions import fields
from clickloom.operators.contract import DEFAULT, Contract
from clickloom.sources.day_store import DAY, DayStore, Entry
from clickloom.sources.quarantine import CLEAN, QUARANTINE, REPEAT, zoned
from clickloom.streaming.incremental import DAY_LENGTH, STEP, day_before, high_water, instant

ZONES, SEEN, FINDINGS = "zones", "seen", "findings"
LATE = "late"
LATENESS_DAYS = 3
FINDING_SCHEMA = f"rule string, severity string, n long, total long, {DAY} date"


@dataclass(frozen=True)
class Gate:
    """The rules about a whole day that hold back its publication."""

    null_rate: float = DEFAULT.critical_null_rate  # R3
    required: tuple[str, ...] = ()  # R1: columns that must have a value somewhere in the day
    checkouts: bool = True  # R10: not more completed than started checkouts

    def metrics(self, day: Column, name: str) -> list[Column]:
        """Sums over the counted rows of one day, as named columns."""
        rows = F.when(day, F.col("rows")).otherwise(0)

        def total(test: Column, what: str) -> Column:
            return F.coalesce(F.sum(F.when(test, rows).otherwise(0)), F.lit(0)).alias(f"{name}_{what}")

        return [
            total(F.lit(True), "total"),
            total(F.col("client_id").isNull(), "null_ids"),
            total(F.col("event_name") == "checkout_completed", "completed"),
            total(F.col("event_name") == "checkout_started", "started"),
            *[total(F.col(c).isNotNull(), f"present_{c}") for c in self.required],
        ]

    def findings(self, seen: dict[str, int]) -> list[tuple[str, int]]:
        """(rule, n) of the rules a day breaks, from its metrics."""
        total = seen["total"]
        out = [("R1_required_column", 1) for c in self.required if total and not seen[f"present_{c}"]]
        if total and seen["null_ids"] > self.null_rate * total:
            out.append(("R3_null_identity", seen["null_ids"]))
        if self.checkouts and seen["completed"] > seen["started"]:
            out.append(("R10_purchase_follows_checkout", seen["completed"] - seen["started"]))
        return out


def row_hash(columns: Iterable[str]) -> Column:
    """128 bits of a row: text that keeps nulls and borders apart, hashed."""
    parts = [F.coalesce(F.concat(F.length(F.col(f"`{c}`").cast("string")), F.lit(":"), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat(*parts))


def receive_batch(
    store: DayStore,
    raw: DataFrame,
    version: int,
    contract: Contract = DEFAULT,
    lateness_days: float = LATENESS_DAYS,
    gate: Gate | None = None,
    days: Iterable[date] = (),
) -> dict[date, list[tuple[str, int]]] | None:
    """Take in one batch of raw events (with ``event_date``); None if it is published already.

    ``days`` are the days delivered, as the file names say; ``gate`` is applied to them.
    Returns the rules broken by each day that was held back.
    """
    if version in store.versions():
        return None
    mark = high_water(store)
    watermark = None if mark is None else mark - int(lateness_days * DAY_LENGTH)
    counted = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("arrived")).withColumn("row_hash", row_hash(raw.columns))
    known = store.read(SEEN) if watermark is None else store.read(SEEN, since=day_before(watermark))
    if known is None:
        counted = counted.withColumn("known", F.lit(False))
    else:
        # A row's day is part of what is compared: equal rows have equal days.
        met = known.select(F.col("row_hash"), F.lit(True).alias("known")).distinct()
        counted = counted.join(met, "row_hash", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    moment = fields.instant(raw, "timestamp")
    behind = F.lit(False) if watermark is None else F.coalesce(moment < instant(watermark), F.lit(False))
    # Late rows are not compared: the days they belong to are closed.
    new = F.col("late") | ~F.col("known")
    counted = counted.withColumn("late", behind).withColumns(
        {"firsts": F.when(new, F.col("arrived")).otherwise(0), "repeats": F.when(new, 0).otherwise(F.col("arrived"))}
    )
    rows = zoned(counted.drop("arrived", "known"), contract)
    rows = rows.withColumns({
        "zone": F.when(F.col("late"), LATE).otherwise(F.col("zone")),
        "reasons": F.when(F.col("late"), F.array(F.lit(LATE))).otherwise(F.col("reasons")),
        "missed": F.lit(None).cast("timestamp") if watermark is None else F.when(F.col("late"), instant(watermark)),
        "attempts": F.lit(0),
    }).drop("late")

    delivered = sorted(set(days))
    watch = Observation()
    top = F.unix_micros(F.max(F.when(F.col("zone") != LATE, moment))).alias("high_water")
    measures = [m for i, d in enumerate(delivered) for m in gate.metrics(F.col(DAY) == F.lit(d), f"d{i}")] if gate else []
    found_days = store.stage(ZONES, rows.observe(watch, top, F.count(F.lit(1)).alias("any"), *measures), version)
    seen = watch.get
    held_back = {}
    if gate:
        for i, d in enumerate(delivered):
            own = {k.partition("_")[2]: v for k, v in seen.items() if k.startswith(f"d{i}_")}
            if broken := gate.findings(own):
                held_back[d] = [(rule, n, own["total"]) for rule, n in broken]
    published = [d for d in found_days if d not in held_back]
    # Hashes of held-back days are no part of the state: their rows may be delivered again.
    fresh = store.staged(ZONES, version, published).where((F.col("zone") != LATE) & ~F.array_contains("reasons", REPEAT))
    entries = [Entry(ZONES, d) for d in published]
    entries += [Entry(SEEN, d) for d in store.stage(SEEN, fresh.select("row_hash", DAY), version)]
    if held_back:
        findings = [(rule, "CRITICAL", n, total, d) for d, broken in held_back.items() for rule, n, total in broken]
        entries += [Entry(FINDINGS, d) for d in store.stage(FINDINGS, store.spark.createDataFrame(findings, FINDING_SCHEMA), version)]
    marks = [m for m in (mark, None if held_back and not published else seen["high_water"]) if m is not None]
    store.publish(version, entries, json.dumps({"high_water": max(marks)} if marks else {}))
    return {d: [(rule, n) for rule, n, _ in broken] for d, broken in held_back.items()}


def receive_available(store: DayStore, raw: DataFrame, checkpoint: str, **options) -> None:
    """Take in everything a stream of raw events can give now, then stop; ``options`` as of ``receive_batch``."""

    def batch(df: DataFrame, version: int) -> None:
        receive_batch(store, df, (version + 1) * STEP, **options)

    query = raw.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def zone_counts(store: DayStore) -> DataFrame:
    """(event_date, zone, n) of everything published."""
    return store.read(ZONES).groupBy(DAY, "zone").agg(F.sum("rows").alias("n"))


def replay_store(store: DayStore, version: int, contract: Contract = DEFAULT, attempts: int = 5) -> int | None:
    """Judge quarantined rows again and move the good ones to the clean zone; returns how many rows were promoted.

    Both sides of the move are one version: every day with a promoted row is replaced as a
    whole, so a row is in exactly one zone whether or not the run completes.  A row that
    fails counts one more attempt; after ``attempts`` it is left alone, so repeated replays
    come to rest.  Repeats stay held: the copy they repeat is in the clean zone or judged
    here itself.
    """
    if version in store.versions():
        return None
    stored = store.read(ZONES)
    if stored is None:
        return 0
    repeat = F.array_contains("reasons", REPEAT)
    due = (F.col("zone") == QUARANTINE) & ~repeat & (F.col("attempts") < attempts)
    days = [r[0] for r in stored.where(due).select(DAY).distinct().collect()]
    if not days:
        return 0
    here = stored.where(F.col(DAY).isin([d for d in days if d is not None]) | (F.col(DAY).isNull() if None in days else F.lit(False)))
    out = ("zone", "reasons", "rows")
    back = here.where(due).withColumns({"firsts": F.col("rows"), "repeats": F.lit(0).cast("long"), "attempts": F.col("attempts") + 1})
    again = zoned(back.drop(*out), contract)
    rest = here.where(~F.coalesce(due, F.lit(False)))
    watch = Observation()
    moved = F.coalesce(F.sum(F.when((F.col("zone") == CLEAN) & (F.col("promoted")), F.col("rows"))), F.lit(0)).alias("moved")
    both = rest.withColumn("promoted", F.lit(False)).unionByName(again.withColumn("promoted", F.lit(True))).observe(watch, moved)
    written = set(store.stage(ZONES, both.drop("promoted"), version))
    store.publish(version, [Entry(ZONES, d, replaces=True) for d in written | set(days)], "")
    return watch.get["moved"]


def held_days(store: DayStore) -> DataFrame | None:
    """The findings of days that were held back."""
    return store.read(FINDINGS)
