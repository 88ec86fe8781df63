"""Credit spread over every session in the lookback instead of the first or last only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.config import SQL, Settings
from clickloom.functions.channels import CHANNELS
from clickloom.functions.fields import days_before
from clickloom.operators.attribution import before, slices_with_touches
from clickloom.operators.conversions import conversions
from clickloom.operators.sessions import slice_of


def touch_paths(events: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Conversions with ``path``: the touches in their lookback window, by start.

    A path has at most one touch per time slice of the lookback (337 at the defaults),
    however many events the user has, so the array is bounded.
    """
    line = Window.partitionBy("user_id").orderBy("slice")
    candidates = (
        slices_with_touches(events, settings)
        .withColumn("path", F.collect_list("touch").over(line.rangeBetween(-settings.lookback_slices, 0)))
        .where("wanted")
        .select("user_id", "slice", "path")
    )
    at = F.col("conversion_ts")
    opens = days_before(at, settings.lookback_days)
    return (
        conversions(events, settings)
        .withColumn("slice", slice_of(at, settings))
        .join(candidates, ["user_id", "slice"], "left")
        .withColumn(
            "path",
            F.array_sort(
                F.filter(
                    F.coalesce("path", F.array().cast(candidates.schema["path"].dataType)),
                    lambda t: (t["start"] >= opens) & before(t["start"], at, settings),
                )
            ),
        )
        .drop("slice")
    )


def _per_channel(path: Column, weight) -> Column:
    """Array of (channel, weight), the weights of one conversion adding up to 1."""
    weights = F.transform(path, weight)
    total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)

    def share(channel: str) -> Column:
        own = F.transform(F.filter(path, lambda t: t["first_channel"] == channel), weight)
        return F.try_divide(F.aggregate(own, F.lit(0.0), lambda a, w: a + w), total)

    shares = F.array(*[F.struct(F.lit(c).alias("channel"), share(c).alias("weight")) for c in CHANNELS])
    return F.filter(shares, lambda s: s["weight"] > 0)


def spread_credit(paths: DataFrame, model: str = "linear", half_life_days: float = 7.0, fallback: str = "Direct") -> DataFrame:
    """(transaction_id, user_id, channel, weight, credit); no shuffle after the paths.

    'linear' treats all touches alike; 'time_decay' halves a touch per half-life of age.
    """
    if model == "linear":
        weights = _per_channel(F.col("path"), lambda t: F.lit(1.0))
    elif model == "time_decay":
        rate = math.log(2) / (half_life_days * 86_400)
        age = lambda t: F.unix_micros("conversion_ts") / 1e6 - F.unix_micros(t["start"]) / 1e6
        weights = _per_channel(F.col("path"), lambda t: F.exp(-age(t) * rate))
    else:
        raise ValueError(f"unknown model {model!r}")
    alone = F.array(F.struct(F.lit(fallback).alias("channel"), F.lit(1.0).alias("weight")))
    return paths.select(
        "transaction_id",
        "user_id",
        "revenue",
        F.explode(F.when(F.size("path") > 0, weights).otherwise(alone)).alias("share"),
    ).select(
        "transaction_id",
        "user_id",
        "share.channel",
        "share.weight",
        (F.coalesce("revenue", F.lit(0.0)) * F.col("share.weight")).alias("credit"),
    )


def shapley_values(paths: DataFrame, fallback: str = "Direct") -> DataFrame:
    """(channel, value): Shapley value of each channel.

    The worth of a set of channels is the revenue of all conversions whose channels lie
    in it.  That game is a sum of unanimity games, one per observed channel set, whose
    value is shared equally by the set's members, so no subset has to be enumerated.
    """
    touched = F.array_sort(F.array_distinct(F.transform("path", lambda t: t["first_channel"])))
    members = F.when(F.size("path") > 0, touched).otherwise(F.array(F.lit(fallback)))
    per_set = paths.groupBy(members.alias("members")).agg(
        F.sum(F.coalesce("revenue", F.lit(0.0)).try_cast("decimal(38,6)")).alias("revenue")
    )
    part = F.col("revenue").cast("double") / F.size("members")
    return (
        per_set.select(F.explode("members").alias("channel"), part.alias("part"))
        .groupBy("channel")
        .agg(F.sum("part").alias("value"))
    )
