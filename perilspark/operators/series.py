"""Forward-looking windows over a station's daily series.

Input has one row per station and day (see ``calendar.daily_series``), so a
window partition is bounded by the length of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.flags import flag


def _ahead(station: list[str], days: int) -> WindowSpec:
    return Window.partitionBy(*station).orderBy("time").rowsBetween(0, days - 1)


def _when_whole(value: Column, station: list[str], days: int) -> Column:
    """Null on the last ``days - 1`` rows of a station."""
    return F.when(F.count(F.lit(1)).over(_ahead(station, days)) == days, value)


def forward_sum(value: str, station: list[str], days: int) -> Column:
    """Sum of this and the next ``days - 1`` rows; missing values skipped."""
    return _when_whole(F.sum(value).over(_ahead(station, days)), station, days)


def forward_mean(value: str, station: list[str], days: int) -> Column:
    return _when_whole(F.avg(value).over(_ahead(station, days)), station, days)


def forward_run(flag_name: str, station: list[str], days: int) -> Column:
    """How many of this and the next ``days - 1`` rows carry the flag."""
    return _when_whole(F.sum(flag_name).over(_ahead(station, days)), station, days)


def run_target(df: DataFrame, flag_name: str, station: list[str], days: int, count: str, target: str) -> DataFrame:
    """Add the run length and the event flag "all ``days`` rows are flagged"."""
    counted = df.withColumn(count, forward_run(flag_name, station, days))
    return counted.withColumn(target, flag(F.col(count) >= days))
