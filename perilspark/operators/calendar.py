"""Series on a calendar: one row per station and day, gaps made explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import Calendar


def daily_series(df: DataFrame, station: list[str], time: Column | str, /, **aggregates: Column) -> DataFrame:
    """Collapse records to one row per station and day.

    Partial aggregation shrinks a hot station before the shuffle; afterwards a
    station has at most one row per day, the bound all series windows rely on.
    """
    day = F.to_date(F.col(time) if isinstance(time, str) else time).alias("time")
    return df.groupBy(*station, day).agg(*[agg.alias(name) for name, agg in aggregates.items()])


def fill_gaps(series: DataFrame, station: list[str], calendar: Calendar, carry: list[str] = ()) -> DataFrame:
    """Every station on every calendar day, with nulls where no record exists.

    ``carry`` are per-station attributes (coordinates, cluster) set on filled
    rows too. Days are generated from the station list, so nothing is crossed.
    """
    if carry:
        stations = series.groupBy(*station).agg(*[F.max(c).alias(c) for c in carry])
    else:
        stations = series.select(*station).distinct()
    days = calendar.expand(stations)
    return days.join(series.drop(*carry), [*station, "time"], "left")


def restrict_to_calendar(df: DataFrame, calendar: Calendar, time: str = "time") -> DataFrame:
    """Keep the rows whose day is on the calendar."""
    return df.where(calendar.contains(time))


def repeat_over_calendar(static: DataFrame, calendar: Calendar) -> DataFrame:
    """Static rows repeated for every day."""
    return calendar.expand(static)


def coverage_audit(df: DataFrame, calendar: Calendar, time: str = "time", complete_days: int = 300) -> DataFrame:
    """Expected against landed days per year.

    Status: 'success' if every expected day landed, 'partial' if some did,
    'missing' otherwise; ``complete`` if at least ``complete_days`` landed.
    """
    # Days are distinct calendar days, so both sides are bounded by the calendar.
    landed = df.select(F.to_date(time).alias("time")).where(calendar.contains("time")).distinct()
    expected = calendar.frame(df.sparkSession)
    marked = expected.join(landed.withColumn("landed", F.lit(1)), "time", "left")
    counts = marked.groupBy(F.year("time").alias("year")).agg(
        F.count(F.lit(1)).alias("expected_days"),
        F.count("landed").alias("landed_days"),
    )
    return counts.withColumns(
        {
            "missing_days": F.col("expected_days") - F.col("landed_days"),
            "complete": F.when(F.col("landed_days") >= complete_days, 1).otherwise(0),
            "status": F.when(F.col("landed_days") == 0, "missing")
            .when(F.col("landed_days") < F.col("expected_days"), "partial")
            .otherwise("success"),
        }
    )


def missing_days(df: DataFrame, calendar: Calendar, time: str = "time") -> DataFrame:
    """Calendar days without any row."""
    landed = df.select(F.to_date(time).alias("time")).where(calendar.contains("time")).distinct()
    return calendar.frame(df.sparkSession).join(landed, "time", "left_anti")
