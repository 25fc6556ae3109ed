"""Run parameters: a base day and integer day offsets around it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class DateWindow:
    """Closed day window ``[base + start, base + end]``.

    ``buffer`` only widens what a writer clears, never what a reader returns.
    """

    base: date
    start: int = -7
    end: int = 0
    buffer: int = 0

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"start offset {self.start} is after end offset {self.end}")
        if self.buffer < 0:
            raise ValueError("buffer must not be negative")

    @classmethod
    def of_days(cls, first: date, last: date) -> "DateWindow":
        return cls(last, -(last - first).days, 0)

    @property
    def first(self) -> date:
        return self.base + timedelta(days=self.start)

    @property
    def last(self) -> date:
        return self.base + timedelta(days=self.end)

    @property
    def n_days(self) -> int:
        return self.end - self.start + 1

    def days(self) -> list[date]:
        return [self.first + timedelta(days=i) for i in range(self.n_days)]

    def padded(self, lookback: int = 0, lookahead: int = 0) -> "DateWindow":
        """The same window widened to feed lags, rolling sums and late dimensions."""
        return DateWindow(self.base, self.start - lookback, self.end + lookahead)

    def cleanup(self) -> "DateWindow":
        """Days a writer replaces: the window plus ``buffer`` days on the left."""
        return DateWindow(self.base, self.start - self.buffer, self.end)

    def sql_args(self) -> dict[str, object]:
        """Named parameters for ``spark.sql(text, args=...)``."""
        return {
            "base": self.base,
            "start_offset": self.start,
            "end_offset": self.end,
            "first": self.first,
            "last": self.last,
        }


@dataclass(frozen=True)
class SourceOffsets:
    """Extra days one source reads beyond the run window.

    The upper bound stays open unless ``extra_end`` is set.
    """

    extra_start: int = 0
    extra_end: int = 0

    def bounds(self, window: DateWindow) -> tuple[date, date | None]:
        lower = window.first + timedelta(days=self.extra_start)
        upper = window.last + timedelta(days=self.extra_end) if self.extra_end else None
        return lower, upper
