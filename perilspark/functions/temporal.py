"""Date columns, calendars and period keys."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = [
    "Calendar",
    "previous_day",
    "range_key",
    "resolve_period",
    "time_part",
    "with_time_parts",
]

_PARTS = {
    "dayofyear": F.dayofyear,
    "week": F.weekofyear,  # ISO week, as in the source data
    "month": F.month,
    "year": F.year,
    "yearmon": lambda c: F.date_format(c, "yyyyMM"),
}


def time_part(time: Column | str, level: str) -> Column:
    """One calendar part of a date; an unknown level is an error."""
    if level not in _PARTS:
        raise ValueError(f"unknown time level {level!r}; choose from {sorted(_PARTS)}")
    return _PARTS[level](F.col(time) if isinstance(time, str) else time)


def with_time_parts(df: DataFrame, levels: list[str], time: str = "time") -> DataFrame:
    return df.withColumns({level: time_part(time, level) for level in levels})


def previous_day(df: DataFrame, time: str = "time") -> DataFrame:
    """Shift the day back by one and keep the original as ``<time>_orig``."""
    return df.withColumns({f"{time}_orig": F.col(time), time: F.date_sub(time, 1)})


def _as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


@dataclass(frozen=True)
class Calendar:
    """Days from ``start`` to ``end`` (both kept), every ``every`` ``unit``."""

    start: dt.date
    end: dt.date
    every: int = 1
    unit: str = "day"

    def __post_init__(self):
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        if self.every < 1 or self.unit not in ("day", "month"):
            raise ValueError("a calendar steps by a positive number of days or months")

    def days(self) -> Column:
        """The calendar as one literal array; folded by Catalyst."""
        step = f"make_interval(0, {self.every})" if self.unit == "month" else f"make_interval(0, 0, 0, {self.every})"
        return F.expr(f"sequence(DATE'{self.start}', DATE'{self.end}', {step})")

    def contains(self, time: Column | str) -> Column:
        """Membership test that needs no join for day steps."""
        day = F.to_date(F.col(time) if isinstance(time, str) else time)
        inside = self.between(day)
        if self.unit == "day":
            if self.every == 1:
                return inside
            return inside & (F.pmod(F.datediff(day, F.lit(self.start)), F.lit(self.every)) == 0)
        return inside & F.array_contains(self.days(), day)

    def between(self, time: Column | str) -> Column:
        """Whether a day, or a moment within it, lies in the period; reaches the scan."""
        day = F.col(time) if isinstance(time, str) else time
        return (day >= F.lit(self.start)) & (day < F.lit(self.end + dt.timedelta(days=1)))

    def frame(self, spark: SparkSession, name: str = "time") -> DataFrame:
        return spark.range(1).select(F.explode(self.days()).alias(name))

    def expand(self, df: DataFrame, name: str = "time") -> DataFrame:
        """Repeat every row once per day: a generator, not a join."""
        return df.withColumn(name, F.explode(self.days()))

    @property
    def key(self) -> str:
        return range_key(self.start, self.end)

    @property
    def years(self) -> list[int]:
        return list(range(self.start.year, self.end.year + 1))

    def describe(self) -> str:
        first, last = self.start.year, self.end.year
        return f"{first} to {last} ({last - first} year period)"


def range_key(start: dt.date | str, end: dt.date | str) -> str:
    """Period key ``YYYYMMDD_YYYYMMDD``."""
    return f"{_as_date(start):%Y%m%d}_{_as_date(end):%Y%m%d}"


def resolve_period(start_year=None, end_year=None, window: int = 30, today: dt.date | None = None) -> tuple[int, int]:
    """Fill in a missing end (last full year) and start (``window`` years earlier)."""
    end = (today or dt.date.today()).year - 1 if end_year is None else int(end_year)
    return (end - window if start_year is None else int(start_year)), end
