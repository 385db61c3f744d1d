"""Climatologies: circular day-of-year windows and weekly normals.

Day-of-year operators pack a station's records per day of year (at most one
record per year), slide a window over those 365 packed rows and unpack again.
Everything happens under one hash partitioning by station: no multiplied rows
and no join back to the series. ``partitioned=True`` says that the input has
that partitioning already (``by_station``), so it is not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import time_part

REPEATED = "a station has several rows for one day; reduce them with daily_series first"
YEAR_DAYS = 365  # day 366 neither enters a window nor receives a value


def by_station(series: DataFrame, station: list[str]) -> DataFrame:
    """One shuffle that all station-wise operators after it reuse.

    Balanced, because a station has at most one row per calendar day.
    """
    return series.repartition(*station)


def _packed_by_day(series: DataFrame, station: list[str], partitioned: bool, *aggregates: Column) -> DataFrame:
    rows = F.struct(*[c for c in series.columns if c not in station])
    placed = series if partitioned else by_station(series, station)
    packed = (
        placed.withColumn("_doy", F.dayofyear("time"))
        .groupBy(*station, "_doy")
        .agg(F.collect_list(rows).alias("_rows"), F.collect_set(F.year("time")).alias("_years"), *aggregates)
    )
    # Repeated days would weigh twice and let the packed rows grow without bound.
    once = F.col("_doy").isNull() | (F.size("_rows") == F.size("_years"))
    return packed.where(F.assert_true(once, F.lit(REPEATED)).isNull()).drop("_years")


def _with_circular_halo(packed: DataFrame, window: int) -> DataFrame:
    """Repeat the first and last ``window`` days beyond the year's ends."""
    if not 0 < 2 * window + 1 <= YEAR_DAYS:
        raise ValueError("the window must be positive and shorter than a year")
    doy = F.col("_doy")
    main = F.struct(doy.alias("pos"), F.lit(True).alias("own"))
    after = F.when(doy <= window, F.struct((doy + YEAR_DAYS).alias("pos"), F.lit(False).alias("own")))
    late = (doy > YEAR_DAYS - window) & (doy <= YEAR_DAYS)
    before = F.when(late, F.struct((doy - YEAR_DAYS).alias("pos"), F.lit(False).alias("own")))
    places = F.array_compact(F.array(main, after, before))
    return packed.withColumn("_at", F.explode(places)).withColumn("_rows", F.when(F.col("_at.own"), F.col("_rows")))


def doy_moments(
    series: DataFrame, value: str, station: list[str], window: int = 7, digits: int | None = 4, partitioned: bool = False
) -> DataFrame:
    """Mean and population std over ±``window`` days of year, on every row.

    Adds ``clim_<value>_mean`` and ``clim_<value>_std``. Per-day moments are
    merged around a station-level origin, which keeps the merge accurate.
    """
    in_year = F.when(F.col("_doy") <= YEAR_DAYS, F.col(value))
    packed = _packed_by_day(
        series,
        station,
        partitioned,
        F.count(in_year).alias("_n"),
        F.avg(in_year).alias("_m"),
        (F.var_pop(in_year) * F.count(in_year)).alias("_m2"),
    )
    origin = F.avg("_m").over(Window.partitionBy(*station))
    shifted = packed.withColumn("_d", F.col("_m") - origin).withColumn("_c", origin)
    near = Window.partitionBy(*station).orderBy("_at.pos").rangeBetween(-window, window)
    n = F.sum("_n").over(near)
    gap = F.try_divide(F.sum(F.col("_n") * F.col("_d")).over(near), n)
    spread = F.sum(F.col("_m2") + F.col("_n") * F.col("_d") * F.col("_d")).over(near)
    mean, std = gap + F.col("_c"), F.sqrt(F.greatest(F.try_divide(spread, n) - gap * gap, F.lit(0.0)))
    if digits is not None:
        mean, std = F.round(mean, digits), F.round(std, digits)
    in_range = F.col("_doy") <= YEAR_DAYS
    done = _with_circular_halo(shifted, window).withColumns(
        {
            f"clim_{value}_mean": F.when(in_range, mean),
            f"clim_{value}_std": F.when(in_range, std),
        }
    )
    out = done.where("_at.own").withColumn("_row", F.explode("_rows"))
    return out.select(
        *[c if c in station else F.col(f"_row.{c}").alias(c) for c in series.columns],
        f"clim_{value}_mean",
        f"clim_{value}_std",
    )


def doy_percentile(
    series: DataFrame,
    values: str | list[str],
    station: list[str],
    window: int = 3,
    digits: int | None = 4,
    partitioned: bool = False,
) -> DataFrame:
    """Percentile rank of each value within ±``window`` days of year.

    Ties share their average rank; the rank is a share of the non-missing
    values, in percent. Adds ``perc_<value>`` for every value, in one pass.
    """
    values = [values] if isinstance(values, str) else values
    kept = [F.collect_list(F.when(F.col("_doy") <= YEAR_DAYS, F.col(v))).alias(f"_v{i}") for i, v in enumerate(values)]
    packed = _packed_by_day(series, station, partitioned, *kept)
    near = Window.partitionBy(*station).orderBy("_at.pos").rangeBetween(-window, window)
    pools = {f"_up{i}": F.sort_array(F.flatten(F.collect_list(f"_v{i}").over(near))) for i in range(len(values))}
    pooled = _with_circular_halo(packed, window).withColumns(pools).where("_at.own")
    pooled = pooled.withColumns({f"_down{i}": F.reverse(f"_up{i}") for i in range(len(values))})

    def share(i: int, v: Column) -> Column:
        # First and last place of the value in the sorted pool.
        first = F.array_position(f"_up{i}", v)
        last = F.size(f"_up{i}") + 1 - F.array_position(f"_down{i}", v)
        percent = (first + last) / 2 / F.size(f"_up{i}") * 100
        known = v.isNotNull() & (F.col("_doy") <= YEAR_DAYS)
        return F.when(known, percent if digits is None else F.round(percent, digits))

    rows = pooled.withColumn("_row", F.explode("_rows"))
    return rows.select(
        *[c if c in station else F.col(f"_row.{c}").alias(c) for c in series.columns],
        *[share(i, F.col(f"_row.{v}")).alias(f"perc_{v}") for i, v in enumerate(values)],
    )


def full_years(df: DataFrame, time: str = "time", min_days: int = 360) -> Column:
    """Array of years with at least ``min_days`` distinct days, as a scalar.

    The list is bounded by the calendar, so callers filter with
    ``array_contains`` and the big side is not shuffled.
    """
    days = df.select(F.to_date(time).alias("d")).distinct()
    years = days.groupBy(F.year("d").alias("y")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_days)
    return years.agg(F.collect_set("y")).scalar()


def weekly_climatology(
    df: DataFrame,
    values: list[str],
    cell: list[str],
    time: str = "time",
    level: str = "week",
    smooth: int = 2,
    min_days: int = 360,
) -> DataFrame:
    """Mean and population std per cell and week on full years.

    Columns ``clim_<v>`` and ``std_<v>`` for every variable, from one pass.
    ``smooth`` > 0 takes a circular running mean over ±``smooth`` weeks.
    """
    whole = df.where(F.array_contains(full_years(df, time, min_days), F.year(time)))
    stats = [f(v).alias(f"{p}_{v}") for v in values for p, f in (("clim", F.avg), ("std", F.stddev_pop))]
    weekly = whole.groupBy(*cell, time_part(time, level).alias(level)).agg(*stats)
    return circular_smooth(weekly, [f"{p}_{v}" for v in values for p in ("clim", "std")], cell, level, smooth)


def circular_smooth(weekly: DataFrame, values: list[str], cell: list[str], level: str = "week", reach: int = 2) -> DataFrame:
    """Centred mean over ±``reach`` positions of a closed cycle."""
    if reach <= 0:
        return weekly
    whole = Window.partitionBy(*cell)
    ranked = weekly.withColumns(
        {"_p": F.row_number().over(whole.orderBy(level)), "_len": F.count(F.lit(1)).over(whole)}
    )
    p, n = F.col("_p"), F.col("_len")
    copies = F.array_compact(F.array(p, F.when(p <= reach, p + n), F.when(p > n - reach, p - n)))
    spread = ranked.withColumn("_at", F.explode(copies))
    near = whole.orderBy("_at").rangeBetween(-reach, reach)
    smoothed = spread.withColumns({v: F.avg(v).over(near) for v in values})
    return smoothed.where(F.col("_at") == F.col("_p")).drop("_p", "_len", "_at")


def attach_climatology(df: DataFrame, climatology: DataFrame, cell: list[str], level: str = "week", time: str = "time") -> DataFrame:
    """Left lookup by cell and week; a week without a normal gives null."""
    return df.withColumn(level, time_part(time, level)).join(climatology, [*cell, level], "left")


def standardised(df: DataFrame, values: list[str], level: str = "week") -> DataFrame:
    """``anom_<v>`` = (v - clim) / std; a zero std gives null."""
    anomalies = {f"anom_{v}": F.try_divide(F.col(v) - F.col(f"clim_{v}"), F.col(f"std_{v}")) for v in values}
    spent = [f"{p}_{v}" for v in values for p in ("clim", "std")]
    return df.withColumns(anomalies).drop(*spent, level)


def anomaly_features(
    df: DataFrame, values: list[str], cell: list[str], time: str = "time", smooth: int = 2, min_days: int = 360
) -> tuple[DataFrame, DataFrame]:
    """Training path: anomalies against the data's own normals.

    Returns (features, climatology); store the climatology for daily runs.
    """
    climatology = weekly_climatology(df, values, cell, time, "week", smooth, min_days)
    return standardised(attach_climatology(df, climatology, cell, "week", time), values), climatology


def anomaly_from_stored(df: DataFrame, climatology: DataFrame, values: list[str], cell: list[str], time: str = "time") -> DataFrame:
    """Update path: anomalies against a stored climatology."""
    return standardised(attach_climatology(df, climatology, cell, "week", time), values)


def raw_anomaly(df: DataFrame, climatology: DataFrame, values: list[str], cell: list[str], time: str = "time") -> DataFrame:
    """``anom_<v>`` = v - clim, with the normals kept in ``clim_<v>``."""
    joined = attach_climatology(df, climatology, cell, "week", time)
    return joined.withColumns({f"anom_{v}": F.col(v) - F.col(f"clim_{v}") for v in values})
