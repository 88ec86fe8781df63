"""Marketing channel of an event, under two rule sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, rule set A: utm_medium values per channel, then referrer host markers.
MEDIUMS = {
    "Paid Search": ("cpc", "ppc", "paidsearch", "paid_search", "paid"),
    "Paid Social": ("social", "social-paid", "paidsocial"),
    "Email": ("email", "klaviyo"),
    "Display": ("display", "banner"),
    "Affiliate": ("affiliate",),
}
HOST_MARKERS = {
    "Organic Search": ("google", "bing"),
    "Organic Social": ("facebook", "t.co", "instagram"),
}

# Fixed values, rule set B: markers looked for in the whole URL, then in the referrer.
URL_MARKERS = {
    "Paid Search": ("utm_medium=cpc", "utm_medium=paid"),
    "Paid Social": ("utm_source=facebook", "utm_source=instagram"),
    "Email": ("utm_medium=email",),
}
REFERRER_MARKERS = {
    "Organic Search": ("google.",),
    "Organic Social": ("facebook.", "t.co"),
}
NO_REFERRER_TEXT = "nan"

# Channels that count as paid media, and all channels there are.
PAID_CHANNELS = ("Paid Search", "Paid Social")
CHANNELS = (
    "Paid Search", "Paid Social", "Email", "Display", "Affiliate",
    "Organic Search", "Organic Social", "Direct", "Referral",
)


def _first_match(tests: list[tuple[str, Column]], otherwise: str) -> Column:
    (channel, test), *rest = tests
    chain = F.when(test, channel)
    for channel, test in rest:
        chain = chain.when(test, channel)
    return chain.otherwise(otherwise)


def _mentions(text: Column, markers: tuple[str, ...]) -> Column:
    found = text.contains(markers[0])
    for marker in markers[1:]:
        found = found | text.contains(marker)
    return found


def channel_by_tags(medium: Column, host: Column) -> Column:
    """Rule set A: exact utm_medium first, then the referrer host."""
    tests = [(channel, medium.isin(*values)) for channel, values in MEDIUMS.items()]
    tests += [(channel, _mentions(host, marks)) for channel, marks in HOST_MARKERS.items()]
    tests.append(("Direct", F.coalesce(host, F.lit("")) == ""))
    return _first_match(tests, "Referral")


def channel_by_text(url: Column, referrer: Column) -> Column:
    """Rule set B: markers anywhere in the lower-cased URL, then in the referrer."""
    url = F.lower(F.coalesce(url, F.lit("")))
    referrer = F.lower(F.coalesce(referrer, F.lit("")))
    tests = [(channel, _mentions(url, marks)) for channel, marks in URL_MARKERS.items()]
    tests += [(channel, _mentions(referrer, marks)) for channel, marks in REFERRER_MARKERS.items()]
    tests.append(("Direct", referrer.isin("", NO_REFERRER_TEXT)))
    return _first_match(tests, "Referral")


def is_paid(channel: Column) -> Column:
    return channel.isin(*PAID_CHANNELS)
