"""Scalar column builders for text, URLs, JSON payloads, money and time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns that decide which part of a URL counts.
HOST_PATTERN = r"https?://([^/]+)"
UTM_PATTERN = r"[?&]utm_{name}=([^&]+)"

# Text a CSV reader of the data-frame flavour takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Sums of money run on decimals so the result does not depend on row order.
MONEY = "decimal(38,6)"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def captured(text: Column, pattern: str) -> Column:
    """First capture group, NULL instead of '' where the pattern does not match."""
    return blank_to_null(F.regexp_extract(text, pattern, 1))


def url_host(url: Column) -> Column:
    return F.lower(captured(F.coalesce(url, F.lit("")), HOST_PATTERN))


def utm_tag(url: Column, name: str) -> Column:
    """Lower-cased ``utm_<name>``; the value runs to the next '&', fragments included.

    Most URLs carry no tag at all, and the substring test is far cheaper than the pattern.
    """
    return F.when(url.contains(f"utm_{name}="), F.lower(captured(url, UTM_PATTERN.format(name=name))))


def payload_value(payload: Column, key: str) -> Column:
    """Scalar text under a top-level key; NULL for bad JSON, JSON null, objects and arrays."""
    text = F.get_json_object(payload, f"$.{key}")
    nested = (text.startswith("{") | text.startswith("[")) & F.try_parse_json(text).isNotNull()
    return F.when(~nested, text)


def payload_is_broken(payload: Column) -> Column:
    return payload.isNotNull() & F.try_parse_json(payload).isNull()


def with_parsed(events: DataFrame, payload: str = "event_data") -> tuple[DataFrame, str]:
    """The events with their payload as one VARIANT column more, and its name, which no column of theirs has.

    Text that is no JSON is NULL.  Spark keeps a costly column that is read more than once as
    a projection of its own, so however many keys are read the payload is parsed once.
    """
    name = "payload"
    while name.lower() in map(str.lower, events.columns):
        name += "_"
    return events.withColumn(name, F.try_parse_json(payload)), name


def parsed_text(parsed: Column, key: str) -> Column:
    """Text under a top-level key of a parsed payload, JSON text of what is nested; NULL for JSON null."""
    return F.try_variant_get(parsed, f"$.{key}", "string")


def parsed_keys(parsed: Column) -> Column:
    """Top-level keys of a parsed payload; NULL for what is no object."""
    return F.map_keys(parsed.try_cast("map<string,variant>"))


def as_number(text: Column) -> Column:
    return text.try_cast("double")


def truthy(text: Column) -> Column:
    """Keep the text unless it is missing, empty, false, an empty container or zero."""
    number = as_number(text)
    hollow = text.isin("", "false", "{}", "[]") | F.coalesce(number == 0, F.lit(False))
    return F.when(~hollow, text)


def first_truthy(payload: Column, keys: Sequence[str]) -> Column:
    """Text of the first key that holds something other than null, '' or zero."""
    return F.coalesce(*[truthy(F.get_json_object(payload, f"$.{key}")) for key in keys])


def first_truthy_of(parsed: Column, keys: Sequence[str]) -> Column:
    """The same of a parsed payload; a number states its value, so 12.0 reads 12."""
    return F.coalesce(*[truthy(parsed_text(parsed, key)) for key in keys])


def payload_revenue(payload: Column, keys: Sequence[str]) -> Column:
    """Revenue from one key as is, or from several keys by the first-truthy rule.

    A single key keeps NULL and zero apart.  With several keys, a payload that is no
    JSON, holds none of the keys, or holds text that is no number counts as 0.
    """
    if len(keys) == 1:
        return as_number(payload_value(payload, keys[0]))
    return F.coalesce(as_number(first_truthy(payload, keys)), F.lit(0.0))


def money(amount: Column) -> Column:
    return amount.try_cast(MONEY)


def money_sum(amount: Column) -> Column:
    """Order-independent sum of money as a double; NULL when nothing was summed."""
    return F.sum(money(amount)).cast("double")


def money_total(amount: Column) -> Column:
    return F.coalesce(money_sum(amount), F.lit(0.0))


def instant(events: DataFrame, column: str, on_bad: str = "null") -> Column:
    """A TIMESTAMP column from ISO text, TIMESTAMP or TIMESTAMP_NTZ."""
    if isinstance(events.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(F.col(column)) if on_bad == "null" else F.to_timestamp(F.col(column))
    return F.col(column).cast("timestamp")


def whole_minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes, truncated."""
    return F.timestamp_diff("MINUTE", start, end)


def days_before(moment: Column, days: int) -> Column:
    return moment - F.expr(f"INTERVAL {int(days)} DAYS")


def time_slice(moment: Column, seconds: int) -> Column:
    """Index of the half-open slice of the given length a moment lies in."""
    return F.floor(F.unix_seconds(moment) / seconds)


def null_share(column: Column) -> Column:
    return F.avg(column.isNull().cast("double"))


def percent_text(share: Column, digits: int = 1) -> Column:
    """A share as percent text; ties go to the even digit."""
    return F.format_string(f"%.{digits}f%%", F.bround(share * 100, digits))


def either(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def change_from_previous(value: Column, window) -> Column:
    """Relative change against the previous row, missing values padded forward first."""
    padded = F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.try_divide(padded - before, before)
