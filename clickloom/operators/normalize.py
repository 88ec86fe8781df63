"""Raw events to staged events: identity, time, payload and campaign fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.config import SQL, Settings
from clickloom.functions import fields
from clickloom.functions.channels import channel_by_tags, channel_by_text

# Column names that may stand in for the expected ones, and the events
# that count as a conversion.
ALIASES = {"clientId": "client_id", "pageURL": "page_url", "referrer_url": "referrer"}
CONVERSION_EVENTS = ("purchase", "checkout_completed")

STAGED_COLUMNS = (
    "user_id", "event_ts", "event_name", "page_url", "referrer_host", "revenue", "transaction_id",
    "utm_source", "utm_medium", "utm_campaign", "event_date",
)


def fold_aliases(events: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Bring every alternate column under its expected name.

    Where both names exist the expected one wins row by row, so a table that mixes
    days before and after a rename needs no per-day handling.
    """
    for alternate, name in aliases.items():
        if alternate not in events.columns:
            continue
        if name in events.columns:
            events = events.withColumn(name, F.coalesce(name, alternate)).drop(alternate)
        else:
            events = events.withColumnRenamed(alternate, name)
    return events


def drifted_columns(events: DataFrame, aliases: dict[str, str] = ALIASES) -> list[str]:
    """Alternate names present while the expected name is absent (schema metadata only)."""
    return [a for a, name in aliases.items() if a in events.columns and name not in events.columns]


def fill_missing(events: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Add absent columns as NULL strings."""
    absent = [n for n in names if n not in events.columns]
    return events.withColumns({n: F.lit(None).cast("string") for n in absent}) if absent else events


# Where a row came from is no part of it: a copy in another file is a copy.
PROVENANCE = ("file", "header", "_corrupt_record", "ingest_date")


def event_key(events: DataFrame) -> Column:
    """Tie-break between events of one instant: the event id, else a hash of the row."""
    if "event_id" in events.columns:
        return F.col("event_id")
    return F.xxhash64(*[F.col(f"`{c}`") for c in events.columns if c not in PROVENANCE])


def is_conversion(event_name: Column | None = None) -> Column:
    return (F.col("event_name") if event_name is None else event_name).isin(*CONVERSION_EVENTS)


def stage_events(raw: DataFrame, settings: Settings = SQL) -> DataFrame:
    """Staged events with a derived channel; rows without any identity are dropped, and unreadable lines.

    Narrow unless ``dedupe_rows`` is set, so column pruning and date filters on the
    result reach the scan.
    """
    if "_corrupt_record" in raw.columns:
        raw = raw.where(F.col("_corrupt_record").isNull())
    events = fill_missing(fold_aliases(raw), ("client_id", "referrer", "page_url", "event_data"))
    events = events.withColumn("event_ts", fields.instant(events, "timestamp", settings.bad_timestamp))
    events = events.withColumn("event_key", event_key(events))
    if settings.dedupe_rows:
        identity = [c for c in events.columns if c not in ("timestamp", "event_key", *PROVENANCE)]
        events = events.dropDuplicates(identity)
    channel = (
        channel_by_tags(F.col("utm_medium"), F.col("referrer_host"))
        if settings.rules == "A"
        else channel_by_text(F.col("page_url"), F.col("referrer"))
    )
    return (
        events.where(F.col("client_id").isNotNull())
        .select(
            F.col("client_id").alias("user_id"),
            "event_ts",
            "event_name",
            "page_url",
            "referrer",
            fields.url_host(F.col("referrer")).alias("referrer_host"),
            fields.payload_revenue(F.col("event_data"), settings.revenue_keys).alias("revenue"),
            fields.payload_value(F.col("event_data"), "transaction_id").alias("transaction_id"),
            *[fields.utm_tag(F.col("page_url"), n).alias(f"utm_{n}") for n in ("source", "medium", "campaign")],
            F.to_date("event_ts").alias("event_date"),
            "event_key",
        )
        .withColumn("derived_channel", channel)
    )


def staged_table(staged: DataFrame) -> DataFrame:
    """The columns of the staged table, in order."""
    return staged.select(*STAGED_COLUMNS)
