"""Event targets: cold runs and extreme multi-day rain."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import flag, threshold_name
from ..functions.temporal import Calendar, previous_day
from ..operators.bias import blend, mean_variance_scaling, with_monthly_bias
from ..operators.calendar import daily_series
from ..operators.climatology import by_station, doy_moments, doy_percentile
from ..operators.columns import in_box, include_exclude
from ..operators.grid import GridSpec, match_to_grid, select_points
from ..operators.joins import broadcast_if_small
from ..operators.spatial import polygon_join
from ..session import materialise
from ..operators.series import forward_mean, forward_run, forward_sum


def cold_day_target(
    series: DataFrame,
    value: str,
    station: list[str],
    sd_thresholds: list[float],
    run_days: list[int],
    suffix: str,
    window: int = 7,
    partitioned: bool = False,
) -> DataFrame:
    """Flag days ``t`` stds below normal and runs of ``d`` such days.

    Adds, per threshold t and length d: ``flag_tmin_{t}sd_*``,
    ``n_{t}sd_next{d}d_*`` and ``target_{t}sd_{d}d_*``.
    """
    out = doy_moments(series, value, station, window, partitioned=partitioned)
    mean, std = F.col(f"clim_{value}_mean"), F.col(f"clim_{value}_std")
    flags = {f"flag_tmin_{threshold_name(t)}sd_{suffix}": flag(F.col(value) <= mean - t * std) for t in sd_thresholds}
    out = out.withColumns({f"{value}_bin_{suffix}": flag(F.col(value) <= 0), **flags})
    runs, targets = {}, {}
    for t in map(threshold_name, sd_thresholds):
        for d in run_days:
            count = f"n_{t}sd_next{d}d_{suffix}"
            runs[count] = forward_run(f"`flag_tmin_{t}sd_{suffix}`", station, d)
            targets[f"target_{t}sd_{d}d_{suffix}"] = flag(F.col(f"`{count}`") >= d)
    return out.withColumns(runs).withColumns(targets)


def _percentile_target(series, value, station, percentiles, days, suffix, name, window, ahead, hit, binary, partitioned):
    series = series if partitioned else by_station(series, station)
    out = series.withColumns(
        {f"{value}_bin_{suffix}": binary, **{f"{name}_next{d}d_{suffix}": ahead(value, station, d) for d in days}}
    )
    out = doy_percentile(out, [f"{name}_next{d}d_{suffix}" for d in days], station, window, partitioned=True)
    targets = {
        f"target_P{threshold_name(p)}_{d}d_{suffix}": flag(hit(F.col(f"perc_{name}_next{d}d_{suffix}"), p))
        for d in days
        for p in percentiles
    }
    return out.withColumns(targets)


def rain_percentile_target(
    series: DataFrame,
    value: str,
    station: list[str],
    percentiles: list[float],
    sum_days: list[int],
    suffix: str,
    name: str = "prcp",
    window: int = 3,
    partitioned: bool = False,
) -> DataFrame:
    """Flag days whose ``d``-day total reaches a day-of-year percentile.

    Totals are rounded to 6 digits before ranking: equal totals must tie
    whatever order their days were added in.
    """

    def total(v, keys, d):
        return F.round(forward_sum(v, keys, d), 6)

    return _percentile_target(
        series, value, station, percentiles, sum_days, suffix, name, window,
        total, lambda rank, p: rank >= p, flag(F.col(value) > 0), partitioned,
    )


def cold_percentile_target(
    series: DataFrame,
    value: str,
    station: list[str],
    percentiles: list[float],
    mean_days: list[int],
    suffix: str,
    name: str = "tmin",
    window: int = 3,
    partitioned: bool = False,
) -> DataFrame:
    """Flag days whose ``d``-day mean falls to a day-of-year percentile."""

    def mean(v, keys, d):
        return F.round(forward_mean(v, keys, d), 6)

    return _percentile_target(
        series, value, station, percentiles, mean_days, suffix, name, window,
        mean, lambda rank, p: rank <= p, flag(F.col(value) <= 0), partitioned,
    )


@dataclass(frozen=True)
class TargetArea:
    """Where targets are built: bounds, grids and administrative polygons."""

    bounds: dict[str, float]
    population_grid: GridSpec
    product_grid: GridSpec
    areas: DataFrame
    area_columns: list[str]


@dataclass(frozen=True)
class ColdParams:
    sd_thresholds: list[float] = field(default_factory=lambda: [1, 1.5])
    run_days: list[int] = field(default_factory=lambda: [3, 5])


@dataclass(frozen=True)
class RainParams:
    percentiles: list[float] = field(default_factory=lambda: [90, 95, 97])
    sum_days: list[int] = field(default_factory=lambda: [3, 5])


#: A day's value from several readings.
DAILY = {"tmin": F.min, "prcp": F.sum}


def station_series(
    records: DataFrame,
    calendar: Calendar,
    where: TargetArea,
    inclusive: bool = True,
    clusters: DataFrame | None = None,
    shift_day: bool = False,
    gap_fill: bool = True,
    station: str = "station_id",
    daily: dict[str, Callable[[str], Column]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Station records inside bounds, period and polygons, on the calendar.

    ``time`` is a day or a moment. Several records of a station and day become
    one before they are joined: ``daily`` names a column's aggregate (by
    default the minimum of ``tmin`` and the sum of ``prcp``, missing values
    skipped); other columns take their largest value. A station's place is its
    largest longitude and latitude. The exchange is the one the join needs.

    Returns (series, located stations with their areas). Only stations inside
    a polygon enter the series, which is known from the short station list
    before any record is joined. ``gap_fill=False`` keeps records only, so
    that "next days" means next records.
    """
    inside = records.where(in_box("lon", "lat", **where.bounds, inclusive=inclusive) & calendar.between("time"))
    stations = inside.groupBy(station).agg(F.max("lon").alias("lon"), F.max("lat").alias("lat"))
    if clusters is not None:
        stations = stations.join(clusters.select(station, "cluster"), station, "left")
    # A run uses the station list four times; written once, the records are
    # scanned for it only once.
    located = materialise(polygon_join(stations, where.areas, where.area_columns), "stations")
    stations = located.drop(*where.area_columns).distinct()
    reduce = {**DAILY, **(daily or {})}
    kept = [c for c in inside.columns if c not in (station, "time", "lon", "lat")]
    values = daily_series(inside, [station], "time", **{c: reduce.get(c, F.max)(c) for c in kept})
    values = previous_day(values) if shift_day else values
    if gap_fill:
        series = calendar.expand(stations).join(values, [station, "time"], "left")
    else:
        series = values.join(stations, station)
    return series, located


def attach_product(
    series: DataFrame, stations: DataFrame, product: DataFrame, grid: GridSpec, value: str, name: str, calendar: Calendar
) -> DataFrame:
    """Left join of the product value at each station's nearest node and day.

    The product is first cut to the period and the stations' nodes, so a large
    product is scanned and filtered, not shuffled. Its coordinates may carry
    noise (stored as float, say) of up to a hundredth of a grid step.
    """
    nodes = match_to_grid(series, grid, "lon", "lat", "_plon", "_plat")
    wanted = match_to_grid(stations, grid, "lon", "lat").select("lon", "lat")
    exact = product.where(calendar.between("time")).select(F.col("lon").cast("double"), F.col("lat").cast("double"), "time", value)
    node_lon, node_lat = grid.nearest("lon", "lat")
    near = (F.greatest(F.abs(F.col("lon") - node_lon), F.abs(F.col("lat") - node_lat)) * grid.nodes_per_degree) < 0.01
    cut = select_points(exact.where(near).withColumns({"lon": node_lon, "lat": node_lat}), wanted)
    cut = cut.select(F.col("lon").alias("_plon"), F.col("lat").alias("_plat"), "time", F.col(value).alias(name))
    return nodes.join(cut, ["_plon", "_plat", "time"], "left").drop("_plon", "_plat")


def _located_target(target: DataFrame, station_areas: DataFrame, where: TargetArea, station: str) -> DataFrame:
    """Station coordinates under their own name, grid node as lon/lat, areas."""
    named = target.withColumnsRenamed({"lon": "lon_station", "lat": "lat_station"})
    placed = match_to_grid(named, where.population_grid, "lon_station", "lat_station")
    return placed.join(broadcast_if_small(station_areas.select(station, *where.area_columns)), station)


def cold_spell_target(
    records: DataFrame,
    product: DataFrame,
    calendar: Calendar,
    where: TargetArea,
    params: ColdParams | None = None,
    clusters: DataFrame | None = None,
    gap_fill: bool = True,
    station: str = "station_id",
) -> DataFrame:
    """Cold-spell events from station and gridded minimum temperature.

    ``records``: station, time, lon, lat, tmin. ``product``: lon, lat, time,
    tmin on ``where.product_grid``.
    """
    params = params or ColdParams()
    series, areas = station_series(records, calendar, where, True, clusters, False, gap_fill, station)
    series = series.withColumnRenamed("tmin", "tmin_lfa")
    both = by_station(attach_product(series, areas, product, where.product_grid, "tmin", "tmin_chirts", calendar), [station])
    blended = mean_variance_scaling(both, [station], "tmin_lfa", "tmin_chirts", "tmin_chirts_adj", "tmin")
    target = cold_day_target(
        blended, "tmin", [station], params.sd_thresholds, params.run_days, "final", partitioned=True
    )
    return _located_target(target, areas, where, station)


def extreme_rain_target(
    records: DataFrame,
    product: DataFrame,
    calendar: Calendar,
    where: TargetArea,
    params: RainParams | None = None,
    clusters: DataFrame | None = None,
    include: dict[str, list] | None = None,
    exclude: dict[str, list] | None = None,
    gap_fill: bool = True,
    station: str = "station_id",
) -> DataFrame:
    """Extreme-rain events from station and gridded daily rain.

    A station reading belongs to the day before it is read. ``records``:
    station, time, lon, lat, prcp; ``product``: lon, lat, time, prcp.
    """
    params = params or RainParams()
    chosen = include_exclude(records, include, exclude)
    series, areas = station_series(chosen, calendar, where, False, clusters, True, gap_fill, station)
    series = series.withColumnRenamed("prcp", "prcp_lfa")
    both = by_station(attach_product(series, areas, product, where.product_grid, "prcp", "prcp_chirps", calendar), [station])
    scaled = with_monthly_bias(both, [station], "prcp_lfa", "prcp_chirps", "prcp_chirps_adj")
    blended = scaled.withColumn("prcp", blend("prcp_lfa", "prcp_chirps_adj"))
    target = rain_percentile_target(
        blended, "prcp", [station], params.percentiles, params.sum_days, "final", partitioned=True
    )
    return _located_target(target, areas, where, station)


TARGET_BUILDERS = {"tmin": cold_spell_target, "prcp": extreme_rain_target}


def create_target(variable: str, *args, **kwargs) -> DataFrame:
    """Event target of a hazard, by its variable."""
    if variable not in TARGET_BUILDERS:
        raise KeyError(f"no target is defined for {variable!r}; choose from {sorted(TARGET_BUILDERS)}")
    return TARGET_BUILDERS[variable](*args, **kwargs)
