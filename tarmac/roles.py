"""Column roles and window specifications, with early validation."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DURATION = re.compile(r"^\s*(\d+)\s*(second|minute|hour|day|week)s?\s*$", re.I)
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str | int) -> int:
    """Parse ``"30 seconds"`` / ``"3 minutes"`` / ``30`` (seconds) to seconds."""
    if isinstance(text, int):
        if text <= 0:
            raise ValueError(f"duration must be positive, got {text}")
        return text
    m = _DURATION.match(str(text))
    if not m:
        raise ValueError(f"unsupported duration {text!r}; use '<n> seconds|minutes|hours|days|weeks'")
    n = int(m.group(1))
    if n <= 0:
        raise ValueError(f"duration must be positive, got {text!r}")
    return n * _UNIT_SECONDS[m.group(2).lower()]


def _as_interval(seconds: int) -> str:
    return f"{seconds} seconds"


@dataclass(frozen=True)
class WindowSpec:
    """Tumbling or sliding event-time window.

    ``slide`` defaults to ``duration`` (tumbling). A slide longer than the
    duration is rejected here rather than at analysis time.
    """

    duration: str | int
    slide: str | int | None = None
    kind: str = "auto"  # "tumbling", "sliding" or "auto" (sliding iff slide given)

    def __post_init__(self):
        if self.kind not in ("auto", "tumbling", "sliding"):
            raise ValueError(f"window kind must be tumbling or sliding, got {self.kind!r}")
        d = duration_seconds(self.duration)
        if self.kind == "tumbling" and self.slide is not None and duration_seconds(self.slide) != d:
            raise ValueError("a tumbling window cannot have a slide different from its duration")
        s = self.slide_seconds
        if s > d:
            raise ValueError(f"slide ({s}s) must not exceed the window duration ({d}s)")

    @property
    def duration_seconds(self) -> int:
        return duration_seconds(self.duration)

    @property
    def slide_seconds(self) -> int:
        if self.kind == "tumbling" or self.slide is None:
            return self.duration_seconds
        return duration_seconds(self.slide)

    @property
    def is_sliding(self) -> bool:
        return self.slide_seconds != self.duration_seconds

    @property
    def copies_per_row(self) -> int:
        """How many windows one row lands in (the Expand factor)."""
        d, s = self.duration_seconds, self.slide_seconds
        return -(-d // s)

    def column(self, ts: str | Column) -> Column:
        ts_col = F.col(ts) if isinstance(ts, str) else ts
        if self.is_sliding:
            return F.window(ts_col, _as_interval(self.duration_seconds), _as_interval(self.slide_seconds))
        return F.window(ts_col, _as_interval(self.duration_seconds))


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise ``ValueError`` naming every requested column that is missing."""
    have = set(df.columns)
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"column(s) {missing} not found; available: {df.columns}")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
