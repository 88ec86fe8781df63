"""Business metrics: funnel, rates, coverage, completeness, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.config import SQL, Settings
from clickloom.functions import fields
from clickloom.operators.normalize import CONVERSION_EVENTS, is_conversion

# The funnel's stages in order with the events that reach them.
FUNNEL = {
    "Site Visitors": ("page_viewed",),
    "Add to Cart": ("product_added_to_cart",),
    "Checkout": ("checkout_started",),
    "Purchase": CONVERSION_EVENTS,
}
MOBILE_PATTERN = "(?i)mobi|android|iphone|ipad"
UNKNOWN_DEVICE = "unknown"


def _stage_counts() -> list[Column]:
    return [F.count_if(F.col("event_name").isin(*names)).alias(stage) for stage, names in FUNNEL.items()]


def funnel(events: DataFrame) -> DataFrame:
    """(position, stage, events): events per stage."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(stage).alias("stage"), F.col(f"`{stage}`").alias("events"))
        for i, stage in enumerate(FUNNEL, 1)
    ]
    return events.agg(*_stage_counts()).select(F.inline(F.array(*rows)))


def _rates() -> list[Column]:
    def share(part: str, whole: str) -> Column:
        return F.try_divide(F.col(f"`{part}`"), F.col(f"`{whole}`"))

    return [
        share("Purchase", "Site Visitors").alias("purchase_rate"),
        share("Add to Cart", "Site Visitors").alias("cart_rate"),
        share("Purchase", "Checkout").alias("checkout_completion"),
    ]


def conversion_rates(events: DataFrame) -> DataFrame:
    return events.agg(*_stage_counts()).select(*_rates())


def attribution_coverage(gold: DataFrame, unattributed: str = "Unattributed") -> DataFrame:
    """Revenue and share per group: unattributed, the top credited channel, all others.

    The window ranks one row per channel.
    """
    per_channel = gold.groupBy(F.col("last_click_channel").alias("channel")).agg(
        F.sum(fields.money(F.col("revenue"))).alias("revenue")
    )
    credited = F.col("channel") != unattributed
    ranked = per_channel.withColumn(
        "place",
        F.row_number().over(Window.partitionBy(credited).orderBy(F.desc_nulls_last("revenue"), "channel")),
    )
    group = F.when(~credited, unattributed).when(F.col("place") == 1, F.col("channel")).otherwise("Other")
    sums = ranked.groupBy(group.alias("coverage")).agg(F.sum("revenue").cast("double").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy())
    return sums.withColumn("share", F.try_divide(F.col("revenue"), total))


def prior_session_share(matched: DataFrame) -> DataFrame:
    """One row: conversions, those with an earlier session in the window, their share.

    Takes matched conversions of a strict lookback, so a session opened by the
    conversion itself does not count.
    """
    return matched.agg(
        F.count(F.lit(1)).alias("conversions"),
        F.count_if(F.col("first_touch").isNotNull()).alias("with_prior_session"),
        F.avg(F.col("first_touch").isNotNull().cast("double")).alias("share"),
    )


def identity_completeness(raw: DataFrame, day: str = "event_date") -> DataFrame:
    """Share of rows per day with a value in each raw identity column."""
    return raw.groupBy(F.col(day).alias("event_date")).agg(
        F.avg(F.col("client_id").isNotNull().cast("double")).alias("client_id_share"),
        F.avg(F.col("clientId").isNotNull().cast("double")).alias("alternate_share"),
    )


def purchase_tagging(raw: DataFrame) -> DataFrame:
    """One row: purchases, share with a ``client_id``, share with campaign tags in the URL."""
    tagged = F.coalesce(F.col("page_url").rlike(r"[?&]utm_(source|medium|campaign)=[^&]"), F.lit(False))
    return raw.where(is_conversion()).agg(
        F.count(F.lit(1)).alias("purchases"),
        F.avg(F.col("client_id").isNotNull().cast("double")).alias("client_id_share"),
        F.avg(tagged.cast("double")).alias("utm_share"),
    )


def revenue_inflation(staged: DataFrame) -> DataFrame:
    """One row: revenue of all events with a transaction id, of each id once, the excess."""
    per_transaction = (
        staged.where(is_conversion() & F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(
            F.sum(fields.money(F.col("revenue"))).alias("counted"),
            F.max(fields.money(F.col("revenue"))).alias("kept"),
        )
    )
    return per_transaction.agg(
        F.sum("counted").cast("double").alias("gross_revenue"),
        F.sum("kept").cast("double").alias("net_revenue"),
        (F.sum("counted") - F.sum("kept")).cast("double").alias("inflation"),
    )


def revenue_by_source(staged: DataFrame) -> DataFrame:
    """Revenue and purchases by the utm source on the purchase event."""
    return (
        staged.where(is_conversion())
        .groupBy("utm_source")
        .agg(fields.money_total(F.col("revenue")).alias("revenue"), F.count(F.lit(1)).alias("purchases"))
    )


def period_totals(raw: DataFrame, revenue_keys: tuple[str, ...] = ("value", "revenue", "total")) -> DataFrame:
    """One row: events, purchases and gross revenue (repeated transactions included)."""
    revenue = fields.as_number(fields.first_truthy(F.col("event_data"), revenue_keys))
    return raw.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(is_conversion()).alias("purchases"),
        fields.money_total(F.when(is_conversion(), revenue)).alias("revenue"),
    )


def device_of(user_agent: Column) -> Column:
    return (
        F.when(user_agent.isNull() | (user_agent == ""), UNKNOWN_DEVICE)
        .when(user_agent.rlike(MOBILE_PATTERN), "mobile")
        .otherwise("desktop")
    )


def device_split(events: DataFrame) -> DataFrame:
    """Events and conversion rates per device class."""
    return (
        events.groupBy(device_of(F.col("user_agent")).alias("device"))
        .agg(F.count(F.lit(1)).alias("events"), *_stage_counts())
        .select("device", "events", *_rates())
    )
