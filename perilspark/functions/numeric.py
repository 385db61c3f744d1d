"""Numeric columns: longitudes, snapping, missing values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "lon_to_180",
    "lon_to_360",
    "mean_of_available",
    "nan_to_null",
    "normalise_longitudes",
    "snap_bounds",
    "snap_down",
    "snap_nearest",
    "snap_up",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lon_to_180(lon: Column | str) -> Column:
    """0..360 to -180..180 (180 itself becomes -180).

    A value already in range is passed on bit for bit, so it still joins.
    """
    c = _col(lon)
    inside = (c >= -180) & (c < 180)
    return F.when(inside, c).otherwise(F.pmod(c + 180, F.lit(360.0)) - 180)


def lon_to_360(lon: Column | str) -> Column:
    return F.pmod(_col(lon), F.lit(360.0))


def normalise_longitudes(df: DataFrame, lon: str = "lon") -> DataFrame:
    """Convert to -180..180 only if some longitude is below 0 or above 180.

    The test is one min/max over the column, used as a scalar subquery.
    """
    outside = df.agg(((F.min(lon) < 0) | (F.max(lon) > 180)).alias("outside")).scalar()
    return df.withColumn(lon, F.when(outside, lon_to_180(lon)).otherwise(F.col(lon)))


def snap_down(value: Column | str, parts: int) -> Column:
    return F.floor(_col(value) * parts) / F.lit(float(parts))


def snap_up(value: Column | str, parts: int) -> Column:
    return F.ceil(_col(value) * parts) / F.lit(float(parts))


def snap_nearest(value: Column | str, parts: int) -> Column:
    """Nearest 1/parts; halves go to the even multiple."""
    return F.rint(_col(value) * parts) / F.lit(float(parts))


def snap_bounds(minx: float, miny: float, maxx: float, maxy: float, parts: int = 10) -> dict[str, float]:
    """Grow a bounding box outward to the next 1/parts degree."""
    low = {name: math.floor(v * parts) / parts for name, v in (("minx", minx), ("miny", miny))}
    high = {name: math.ceil(v * parts) / parts for name, v in (("maxx", maxx), ("maxy", maxy))}
    return {**low, **high}


def nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing is null everywhere in this library; apply once when reading."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in columns})


def mean_of_available(a: Column | str, b: Column | str) -> Column:
    """Mean of two values, ignoring a missing one."""
    a, b = _col(a), _col(b)
    return (F.coalesce(a, b) + F.coalesce(b, a)) / 2
