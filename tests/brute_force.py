"""Plain-Python sessions and attribution to check the distributed ones against."""

from __future__ import annotations

from collections import defaultdict
from datetime import timedelta


def sessions(events, settings):
    """events: (user, ts, key, channel) -> list of (user, seq, start, end, n, first, last)."""
    limit = timedelta(minutes=settings.timeout_minutes)
    per_user = defaultdict(list)
    for event in events:
        per_user[event[0]].append(event)
    result = []
    for user, rows in per_user.items():
        rows.sort(key=lambda e: (e[1], e[2]))
        groups = []
        for row in rows:
            gap = row[1] - groups[-1][-1][1] if groups else None
            if gap is None or (gap >= limit if settings.boundary == "ge" else gap > limit):
                groups.append([])
            groups[-1].append(row)
        for seq, group in enumerate(groups, 1):
            result.append((user, seq, group[0][1], group[-1][1], len(group), group[0][3], group[-1][3]))
    return result


def attribution(conversions, session_rows, settings):
    """conversions: (transaction, user, ts) -> {(transaction, user): (first, last)}."""
    span = timedelta(days=settings.lookback_days)
    result = {}
    for transaction, user, at in conversions:
        window = [
            s for s in session_rows
            if s[0] == user and s[2] >= at - span
            and (s[2] <= at if settings.include_conversion_start else s[2] < at)
        ]
        window.sort(key=lambda s: s[2])
        if window:
            last = window[-1][6] if settings.last_click_from == "last" else window[-1][5]
            result[transaction, user] = (window[0][5], last)
        else:
            result[transaction, user] = (settings.fallback, settings.fallback)
    return result
