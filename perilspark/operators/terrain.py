"""Terrain features of a complete raster in long form (lon, lat, altitude).

Box statistics are separable: one window pass along each grid row and one
along each grid column. All window sizes and the slope and aspect neighbours
share these two passes, hence two shuffles in all. A window partition is one
line of the raster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numeric import normalise_longitudes
from .columns import canonical_names
from .grid import GridSpec, regrid_nearest, select_points

METRES_PER_DEGREE = 111_000  # fixed value: turns altitude metres into degrees


def _check(windows: Sequence[int]) -> None:
    even = [w for w in windows if w % 2 == 0]
    if even:
        raise ValueError(f"window sizes must be odd, not {even}")


def _box_mean(value: str, line: WindowSpec, size: int) -> Column:
    """Centred mean along a line; the end values continue beyond the ends."""
    half = size // 2
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position, length = F.row_number().over(line), F.count(F.lit(1)).over(whole)
    before = F.greatest(F.lit(half) - position + 1, F.lit(0))
    after = F.greatest(F.lit(half) - (length - position), F.lit(0))
    inside = _box_edge(F.sum, value, line, size)
    beyond = lambda n, end: F.when(n > 0, n * end.over(whole)).otherwise(0.0)
    return (inside + beyond(before, F.first(value)) + beyond(after, F.last(value))) / size


def _box_edge(pick, value: str, line: WindowSpec, size: int) -> Column:
    """Aggregate of a centred box, null where a cell of the box is missing."""
    box = line.rowsBetween(-(size // 2), size // 2)
    return F.when(F.count(value).over(box) == F.count(F.lit(1)).over(box), pick(value).over(box))


def _gradient(value: str, coordinate: str, line: WindowSpec) -> Column:
    """Central difference for uneven spacing, one-sided at the ends, null beside a missing cell."""
    v, x = F.col(value), F.col(coordinate)
    v0, v2 = F.lag(value).over(line), F.lead(value).over(line)
    back, ahead = x - F.lag(coordinate).over(line), F.lead(coordinate).over(line) - x
    left, right = (v - v0) / back, (v2 - v) / ahead
    centre = (left * ahead + right * back) / (back + ahead)
    return F.when(back.isNull(), right).when(ahead.isNull(), left).otherwise(centre)


def complete_raster(cells: DataFrame) -> DataFrame:
    """A row for every (lat, lon) pair of the raster's lines; ``_given`` marks those that were there.

    The longitudes are gathered once, as many as a raster line has cells.
    """
    lines = cells.select("lat").distinct().withColumn("lon", F.explode(cells.agg(F.collect_set("lon")).scalar()))
    return lines.join(cells.withColumn("_given", F.lit(True)), ["lat", "lon"], "left").select(*cells.columns, "_given")


def terrain(
    cells: DataFrame,
    tpi_windows: Sequence[int] = (),
    tdi_windows: Sequence[int] = (),
    slope: bool = False,
    aspect: bool = False,
    altitude: str = "altitude",
    z_factor: float = 1 / METRES_PER_DEGREE,
    compat_gradient: bool = False,
    dense: bool = False,
) -> DataFrame:
    """Add the requested terrain features.

    TPI_w: altitude minus the w x w mean. TDI_w: (max - min) / mean, 0 where
    the mean is 0. slope: degrees. aspect: compass degrees, -1 on flat ground,
    null on the border. A feature is null where a cell it looks at is missing,
    be its altitude null or its row absent; ``dense`` promises that no row is
    absent and saves a shuffle. ``compat_gradient`` divides the eastward
    gradient by the altitude, which some existing tables contain.
    """
    _check([*tpi_windows, *tdi_windows])
    given = cells.columns
    if not dense:
        cells = complete_raster(cells)
    east = Window.partitionBy("lat").orderBy("lon")
    south = Window.partitionBy("lon").orderBy(F.desc("lat"))
    sizes = sorted({*tpi_windows, *tdi_windows})

    first = {f"_m{w}": _box_mean(altitude, east, w) for w in sizes}
    first |= {f"_lo{w}": _box_edge(F.min, altitude, east, w) for w in tdi_windows}
    first |= {f"_hi{w}": _box_edge(F.max, altitude, east, w) for w in tdi_windows}
    if slope:
        first["_dx"] = _gradient(altitude, "lon", east)
    if aspect:
        first |= {"_w": F.lag(altitude).over(east), "_e": F.lead(altitude).over(east)}
    rows = cells.withColumns(first) if first else cells

    second = {f"_mean{w}": _box_mean(f"_m{w}", south, w) for w in sizes}
    second |= {f"_min{w}": _box_edge(F.min, f"_lo{w}", south, w) for w in tdi_windows}
    second |= {f"_max{w}": _box_edge(F.max, f"_hi{w}", south, w) for w in tdi_windows}
    if slope:
        second["_dy"] = _gradient(altitude, "lat", south)
    if aspect:
        second |= {f"{c}{side}": move(c).over(south) for c in ("_w", altitude, "_e") for side, move in (("_n", F.lag), ("_s", F.lead))}
    both = rows.withColumns(second) if second else rows

    out = {}
    if slope:
        dx = F.try_divide(F.col("_dx"), F.col(altitude)) if compat_gradient else F.col("_dx")
        dy = F.col("_dy")
        out["slope"] = F.degrees(F.atan(F.sqrt(F.pow(dx * z_factor, 2) + F.pow(dy * z_factor, 2))))
    if aspect:
        out["aspect"] = _aspect(altitude)
    out |= {f"TPI_{w}": F.col(altitude) - F.col(f"_mean{w}") for w in tpi_windows}
    spread = {w: F.col(f"_max{w}") - F.col(f"_min{w}") for w in tdi_windows}
    out |= {f"TDI_{w}": F.when(F.col(f"_mean{w}") == 0, 0.0).otherwise(F.try_divide(spread[w], F.col(f"_mean{w}"))) for w in tdi_windows}
    both = both if dense else both.where("_given")
    return both.select(*given, *[c.alias(name) for name, c in out.items()])


def _aspect(altitude: str) -> Column:
    """Downslope compass direction from the eight neighbours."""
    side = lambda name: F.col(f"{name}_n") + 2 * F.col(name) + F.col(f"{name}_s")
    cross = lambda row: F.col(f"_w{row}") + 2 * F.col(f"{altitude}{row}") + F.col(f"_e{row}")
    dx = (side("_e") - side("_w")) / 8
    dy = (cross("_s") - cross("_n")) / 8
    bearing = F.pmod(90 - F.degrees(F.atan2(dy, -dx)), F.lit(360.0))
    return F.when((dx == 0) & (dy == 0), -1.0).when(dx.isNotNull() & dy.isNotNull(), bearing)


def terrain_features(
    elevation: DataFrame,
    tpi_windows: Sequence[int] = (5, 15, 25),
    tdi_windows: Sequence[int] = (5, 15, 25),
    grid: GridSpec | None = None,
    points: DataFrame | None = None,
    compat_gradient: bool = False,
) -> DataFrame:
    """Altitude table to terrain features, on its own grid or regridded.

    ``points`` (lon, lat) keeps only those cells, after the stencils ran.
    """
    cells = canonical_names(elevation, "altitude").select("lon", "lat", "altitude")
    cells = normalise_longitudes(cells)
    if grid is not None:
        cells = regrid_nearest(cells, grid)
    out = terrain(
        cells, tpi_windows, tdi_windows, slope=True, aspect=True, compat_gradient=compat_gradient, dense=grid is not None
    )
    out = out.withColumns({"longitude": F.col("lon"), "latitude": F.col("lat")})
    return out if points is None else select_points(out, points)
