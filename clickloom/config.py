"""One parameter object for every operator, with the two presets the rules come in.

The source material states two conflicting rule sets.  ``SQL`` is the warehouse
flavour and the default; ``PANDAS`` is the data-frame flavour.  Every point on
which they differ is a field here, so a caller can also mix them.
"""

from __future__ import annotations

from dataclasses import dataclass

SECONDS_PER_DAY = 86_400


@dataclass(frozen=True)
class Settings:
    timeout_minutes: int = 30
    # 'ge': a gap of exactly the timeout opens a new session; 'gt': it does not.
    boundary: str = "ge"
    lookback_days: int = 7
    # May a session that starts at the very instant of the conversion be credited?
    include_conversion_start: bool = True
    # Which channel of the last session in the window gets the last click.
    last_click_from: str = "last"
    fallback: str = "Direct"
    id_sep: str = "-S"
    rules: str = "A"
    dedupe_rows: bool = False
    # 'latest': per (transaction, user), newest time and highest revenue.
    # 'earliest': per transaction, oldest row with positive revenue.
    conversion_dedupe: str = "latest"
    revenue_keys: tuple[str, ...] = ("value",)
    # 'sql' keeps NULL revenue, 'zero' turns it into 0 before the maximum is taken.
    null_revenue: str = "sql"
    # Sessions count all rows ('rows') or rows with an event name ('named').
    count_events: str = "rows"
    # Unparseable timestamps: 'null' lets the contract flag them, 'fail' stops the job.
    bad_timestamp: str = "null"
    # Length of the time slices sessions are assembled from.  None picks the longest
    # one that is exact; a shorter one spreads very hot users over more tasks.
    slice_seconds: int | None = None

    def __post_init__(self) -> None:
        choices = {
            "boundary": ("ge", "gt"),
            "last_click_from": ("last", "first"),
            "rules": ("A", "B"),
            "conversion_dedupe": ("latest", "earliest"),
            "null_revenue": ("sql", "zero"),
            "count_events": ("rows", "named"),
            "bad_timestamp": ("null", "fail"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, got {getattr(self, name)!r}")
        if self.timeout_minutes < 1 or self.lookback_days < 1:
            raise ValueError("timeout_minutes and lookback_days must be positive")
        if self.slice_seconds is not None and (
            SECONDS_PER_DAY % self.slice_seconds or self.slice_seconds > self.timeout_minutes * 60
        ):
            raise ValueError("slice_seconds must divide a day and not exceed the timeout")

    @property
    def slice_length(self) -> int:
        """Seconds per slice: divides a day evenly and never exceeds the timeout.

        Two events of one user in the same half-open slice are less than the timeout
        apart, so they always share a session, and no slice holds two session starts.
        """
        if self.slice_seconds is not None:
            return self.slice_seconds
        parts = -(-SECONDS_PER_DAY // (self.timeout_minutes * 60))
        while SECONDS_PER_DAY % parts:
            parts += 1
        return SECONDS_PER_DAY // parts

    @property
    def lookback_slices(self) -> int:
        return self.lookback_days * SECONDS_PER_DAY // self.slice_length


SQL = Settings()

PANDAS = Settings(
    boundary="gt",
    include_conversion_start=False,
    last_click_from="first",
    fallback="Unattributed",
    id_sep="_S",
    rules="B",
    dedupe_rows=True,
    conversion_dedupe="earliest",
    revenue_keys=("value", "revenue"),
    count_events="named",
)
