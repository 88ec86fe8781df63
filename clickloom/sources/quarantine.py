"""Routing of raw events to the clean or the quarantine zone, and replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.contract import DEFAULT, Contract, must_quarantine, tag_rows

CLEAN, QUARANTINE = "clean", "quarantine"
REPEAT = "R8_duplicate_row"


def zoned(counted: DataFrame, contract: Contract) -> DataFrame:
    """Distinct rows with ``firsts`` and ``repeats``, the number of copies not yet and already held as repeats."""
    first = F.least(F.col("firsts"), F.lit(1))
    copies = F.array(
        F.struct(F.lit(True).alias("first"), first.cast("bigint").alias("n")),
        F.struct(F.lit(False).alias("first"), (F.col("firsts") - first + F.col("repeats")).cast("bigint").alias("n")),
    )
    bad = must_quarantine(F.col("findings")) | ~F.col("copy.first")
    return (
        tag_rows(counted, contract)
        .withColumn("copy", F.explode(F.filter(copies, lambda c: c["n"] > 0)))
        .withColumn("zone", F.when(bad, QUARANTINE).otherwise(CLEAN))
        .withColumn("reasons", F.array_distinct(F.transform("findings", lambda f: f["rule"])))
        .withColumn("reasons", F.when(F.col("copy.first"), F.col("reasons")).otherwise(F.array_append("reasons", F.lit(REPEAT))))
        .withColumn("rows", F.col("copy.n"))
        .drop("copy", "firsts", "repeats", "findings")
    )


def route(raw: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """Raw events with ``zone``: quarantine on a critical finding or for a repeated copy.

    The first copy of a row stays clean.  Copies are counted by grouping on the row
    itself, which merges them before the shuffle, not by a window over a group of copies
    that could be of any size; a counted row is unfolded again only where it is written.
    """
    counted = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("firsts"), F.lit(0).cast("bigint").alias("repeats"))
    return zoned(counted, contract)


def write_zones(routed: DataFrame, path: str, day: str = "event_date") -> None:
    """One pass, one write: the zone is the first partition level.

    Rebalancing brings a zone's day together and splits it where it is large.
    """
    routed.hint("rebalance", F.col("zone"), F.col(day)).write.mode("overwrite").partitionBy("zone", day).parquet(path)


def replay(quarantined: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """Quarantined events judged again, for example after a repair or a contract change.

    Rows held as repeats stay held with their count: the copy they repeat is in the clean
    zone or is judged here itself.
    """
    columns = [c for c in quarantined.columns if c not in ("zone", "reasons", "rows")]
    repeat = F.array_contains("reasons", REPEAT)
    counted = quarantined.groupBy(*columns).agg(
        F.sum(F.when(repeat, 0).otherwise(F.col("rows"))).alias("firsts"),
        F.sum(F.when(repeat, F.col("rows")).otherwise(0)).alias("repeats"),
    )
    return zoned(counted, contract)
