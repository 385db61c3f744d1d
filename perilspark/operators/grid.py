"""Regular lon/lat grids: points, snapping, regridding, spatial bounds."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import snap_bounds
from .columns import include_exclude
from .forecast import first_per_key
from .joins import MAX_BROADCAST_ROWS, broadcast_if_small, is_small
from .ordered import ordered_row_number

# An axis map has at most two rows per grid line. Up to this many rows it is
# broadcast; longer axes go through an ordinary shuffle join.
AXIS_BROADCAST_ROWS = 100_000
DIGITS = 6


@dataclass(frozen=True)
class GridSpec:
    """Nodes ``minx + i/n`` eastward and ``maxy - j/n`` southward.

    The far bounds are excluded. Coordinates come from integer indexes and are
    rounded to 6 digits, so equal nodes are equal doubles.
    """

    minx: float
    maxy: float
    nx: int
    ny: int
    nodes_per_degree: int

    @classmethod
    def from_bounds(cls, minx: float, miny: float, maxx: float, maxy: float, nodes_per_degree: int = 10) -> GridSpec:
        count = lambda low, high: max(0, math.ceil(round((high - low) * nodes_per_degree, DIGITS)))
        return cls(minx, maxy, count(minx, maxx), count(miny, maxy), nodes_per_degree)

    def node_lon(self, i: Column) -> Column:
        return F.round(F.lit(float(self.minx)) + i / F.lit(float(self.nodes_per_degree)), DIGITS)

    def node_lat(self, j: Column) -> Column:
        return F.round(F.lit(float(self.maxy)) - j / F.lit(float(self.nodes_per_degree)), DIGITS)

    def points(self, spark: SparkSession) -> DataFrame:
        """The grid as a (lon, lat) table, generated in parallel."""
        n = F.col("id")
        cells = spark.range(self.nx * self.ny)
        return cells.select(self.node_lon(n % self.nx).alias("lon"), self.node_lat(F.floor(n / self.nx)).alias("lat"))

    def axis(self, spark: SparkSession, name: str) -> DataFrame:
        size, node = (self.nx, self.node_lon) if name == "lon" else (self.ny, self.node_lat)
        return spark.range(size).select(node(F.col("id")).alias("target"))

    def broadcast_nodes(self, rows: DataFrame, counted: DataFrame | None = None) -> DataFrame:
        """Hint a broadcast of a table with at most a row per node, by the grid's size, else by counting."""
        if self.nx * self.ny <= MAX_BROADCAST_ROWS:
            return F.broadcast(rows)
        return F.broadcast(rows) if is_small(rows if counted is None else counted) else rows

    def nearest(self, lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
        """Coordinates of the nearest node; outside points go to the edge.

        Half-way points take the smaller coordinate on either axis.
        """
        lon, lat = (F.col(c) if isinstance(c, str) else c for c in (lon, lat))
        n = F.lit(float(self.nodes_per_degree))
        # Rounding removes float noise that would decide half-way points.
        east = F.ceil(F.round((lon - self.minx) * n, DIGITS) - 0.5)
        south = F.floor(F.round((self.maxy - lat) * n, DIGITS) + 0.5)
        clamp = lambda c, top: F.greatest(F.lit(0), F.least(c, F.lit(top - 1)))
        return self.node_lon(clamp(east, self.nx)), self.node_lat(clamp(south, self.ny))


def match_to_grid(df: DataFrame, grid: GridSpec, lon: str, lat: str, out_lon: str = "lon", out_lat: str = "lat") -> DataFrame:
    """Nearest grid node per row: pure arithmetic, no join and no shuffle."""
    node_lon, node_lat = grid.nearest(lon, lat)
    return df.withColumns({out_lon: node_lon, out_lat: node_lat})


def select_points(cells: DataFrame, points: DataFrame, keys: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """Cells at the listed points: a filter by broadcast when they are few."""
    wanted = broadcast_if_small(points.select(*keys).distinct())
    return cells.join(wanted, list(keys), "left_semi")


def padded_id(number: Column, of: Column) -> Column:
    """``ID-`` and the number, padded to the widest number and at least 3."""
    width = F.greatest(F.length(of.cast("string")), F.lit(3))
    digits = number.cast("string")
    return F.concat(F.lit("ID-"), F.repeat(F.lit("0"), width - F.length(digits)), digits)


def number_locations(df: DataFrame, lon: str = "lon", lat: str = "lat", name: str = "location_id") -> DataFrame:
    """Distinct locations numbered ``ID-001…`` west to east, north to south."""
    if lon not in df.columns or lat not in df.columns:
        raise ValueError(f"columns {lon!r} and {lat!r} are required")
    rest = [c for c in df.columns if c not in (lon, lat)]
    places = first_per_key(df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()), [lon, lat], rest) if rest else df.distinct()
    numbered = ordered_row_number(places, [], [F.col(lon), -F.col(lat)], "_i")
    return numbered.withColumn(name, padded_id(F.col("_i"), F.col("_i_of"))).drop("_i", "_i_of")


def total_bounds(geometries: DataFrame) -> dict[str, float]:
    """Joint bounding box: four numbers on the driver."""
    row = geometries.agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")
    ).first()
    if row["minx"] is None:
        raise ValueError("the selection holds no geometry")
    return row.asDict()


def spatial_params(geometries: DataFrame, include=None, exclude=None, parts: int = 10) -> dict[str, float]:
    """Bounds of the selected geometries, grown outward to 1/parts degree."""
    return snap_bounds(**total_bounds(include_exclude(geometries, include, exclude)), parts=parts)


def enclosing_slice(cells: DataFrame, bounds: dict[str, float], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Cells between the grid lines that enclose the bounds.

    A side without an enclosing line uses the outermost line. The four lines
    come from one aggregate used as a scalar subquery.
    """

    def low(c, bound):
        return F.coalesce(F.max(F.when(F.col(c) <= bound, F.col(c))), F.min(c))

    def high(c, bound):
        return F.coalesce(F.min(F.when(F.col(c) >= bound, F.col(c))), F.max(c))

    lines = cells.agg(
        F.struct(
            low(lon, bounds["minx"]).alias("x0"), high(lon, bounds["maxx"]).alias("x1"),
            low(lat, bounds["miny"]).alias("y0"), high(lat, bounds["maxy"]).alias("y1"),
        ).alias("lines")
    ).scalar()
    inside = F.col(lon).between(lines["x0"], lines["x1"]) & F.col(lat).between(lines["y0"], lines["y1"])
    return cells.where(inside)


def _lines(cells: DataFrame, lon: str, lat: str) -> Column:
    """Sorted distinct coordinates of a table on both axes, from one scan, as a scalar subquery."""
    found = cells.agg(*[F.sort_array(F.collect_set(F.col(c).cast("double"))).alias(a) for c, a in ((lon, "lon"), (lat, "lat"))])
    return found.select(F.struct("lon", "lat").alias("lines")).scalar()


def _neighbours(targets: DataFrame, axis: str, source: GridSpec | Column) -> DataFrame:
    """For each target line the source lines just below and above; an equal line is both.

    Between two grids this is arithmetic. Lines read from a table come as
    sorted arrays; a target line is compared with each, on all tasks.
    """
    t = F.col("target")
    if isinstance(source, GridSpec):
        size, node = (source.nx, source.node_lon) if axis == "lon" else (source.ny, source.node_lat)
        place = (t - source.minx if axis == "lon" else F.lit(float(source.maxy)) - t) * source.nodes_per_degree
        place = F.round(place, DIGITS)
        at = lambda i: F.when((i >= 0) & (i < size), node(i))
        near, far = at(F.floor(place)), at(F.ceil(place))
        near, far = F.when(place < 0, None).otherwise(near), F.when(place > size - 1, None).otherwise(far)
        near, far = F.when(place > size - 1, node(F.lit(size - 1))).otherwise(near), F.when(place < 0, node(F.lit(0))).otherwise(far)
        below, above = (near, far) if axis == "lon" else (far, near)
        return targets.select("target", below.alias("below"), above.alias("above"))
    lines = targets.withColumn("_lines", source[axis])
    placed = lines.withColumn("_at", F.size(F.filter("_lines", lambda line: line < t)))
    above = F.get("_lines", F.col("_at"))
    below = F.when(above == t, above).otherwise(F.get("_lines", F.col("_at") - 1))
    # A filter on the result is not pushed below a generator, where it would search again.
    found = placed.select("target", F.explode(F.array(F.struct(below.alias("below"), above.alias("above")))).alias("n"))
    return found.select("target", "n.below", "n.above")


def nearest_axis_map(targets: DataFrame, axis: str, source: GridSpec | Column) -> DataFrame:
    """(target, source) pairs; half-way targets take the larger source."""
    t, lo, hi = F.col("target"), F.col("below"), F.col("above")
    pick = F.when(lo.isNull(), hi).when(hi.isNull(), lo).when(F.round(hi - t, 9) <= F.round(t - lo, 9), hi).otherwise(lo)
    return _neighbours(targets, axis, source).select("target", pick.alias("source"))


def linear_axis_map(targets: DataFrame, axis: str, source: GridSpec | Column) -> DataFrame:
    """(target, source, weight, parts) rows; targets outside are left out."""
    share = F.try_divide(F.col("target") - F.col("below"), F.col("above") - F.col("below"))
    exact = F.col("below") == F.col("above")
    low = F.struct(F.col("below").alias("source"), F.when(exact, 1.0).otherwise(1 - share).alias("weight"))
    high = F.struct(F.col("above").alias("source"), share.alias("weight"))
    pairs = F.when(exact, F.array(low)).otherwise(F.array(low, high))
    inside = _neighbours(targets, axis, source).where(F.col("below").isNotNull() & F.col("above").isNotNull())
    rows = inside.select("target", F.explode(pairs).alias("p"), F.size(pairs).alias("parts"))
    return rows.select("target", "p.source", "p.weight", "parts")


def _source_lines(cells: DataFrame, lon: str, lat: str, source: GridSpec | DataFrame | None) -> GridSpec | Column:
    """A named grid as it is, or the lines that a table holds."""
    return source if isinstance(source, GridSpec) else _lines(cells if source is None else source, lon, lat)


def _small(axis_map: DataFrame, lines: int) -> DataFrame:
    return F.broadcast(axis_map) if 2 * lines <= AXIS_BROADCAST_ROWS else axis_map


def _axis_maps(spark: SparkSession, grid: GridSpec, lines: GridSpec | Column) -> tuple[DataFrame, DataFrame]:
    """Nearest source line of each target line: (_t_lon, _s_lon) and (_t_lat, _s_lat)."""

    def pairs(axis: str, size: int) -> DataFrame:
        found = nearest_axis_map(grid.axis(spark, axis), axis, lines)
        return _small(found.select(F.col("target").alias(f"_t_{axis}"), F.col("source").alias(f"_s_{axis}")), size)

    return pairs("lon", grid.nx), pairs("lat", grid.ny)


def node_cells(
    cells: DataFrame, grid: GridSpec, nodes: DataFrame | None, lon: str = "lon", lat: str = "lat", source: GridSpec | DataFrame | None = None
) -> DataFrame:
    """The source cell of each node, of all the grid's nodes if none are listed: (_t_lon, _t_lat, _s_lon, _s_lat)."""
    x, y = _axis_maps(cells.sparkSession, grid, _source_lines(cells, lon, lat, source))
    wanted = grid.points(cells.sparkSession) if nodes is None else nodes.select("lon", "lat").distinct()
    wanted = wanted.select(F.col("lon").alias("_t_lon"), F.col("lat").alias("_t_lat"))
    return wanted.join(x, "_t_lon").join(y, "_t_lat").select("_t_lon", "_t_lat", "_s_lon", "_s_lat")


def regrid_nearest(
    cells: DataFrame,
    grid: GridSpec,
    lon: str = "lon",
    lat: str = "lat",
    nodes: DataFrame | None = None,
    source: GridSpec | DataFrame | None = None,
) -> DataFrame:
    """Relabel cells to the nearest target nodes, all other columns kept.

    ``source`` names the grid of the cells; without it their distinct
    coordinates are read (from the given table, or from the cells) in one scan.
    ``nodes`` (lon, lat) limits the output to those grid nodes; the cells
    behind them are then picked by one join instead of filling the whole grid.
    """
    if nodes is None:
        x, y = _axis_maps(cells.sparkSession, grid, _source_lines(cells, lon, lat, source))
        at_lon = cells.join(x, F.col(lon) == F.col("_s_lon"))
        joined = at_lon.join(y, F.col(lat) == F.col("_s_lat"))
    else:
        picks = node_cells(cells, grid, nodes, lon, lat, source)
        picks = grid.broadcast_nodes(picks, nodes)
        joined = cells.join(picks, (F.col(lon) == F.col("_s_lon")) & (F.col(lat) == F.col("_s_lat")))
    moved = {lon: "_t_lon", lat: "_t_lat"}
    return joined.select(*[F.col(moved[c]).alias(c) if c in moved else F.col(c) for c in cells.columns])


def regrid_linear(
    cells: DataFrame,
    grid: GridSpec,
    values: list[str],
    keys: list[str] = (),
    lon: str = "lon",
    lat: str = "lat",
    source: GridSpec | DataFrame | None = None,
) -> DataFrame:
    """Bilinear values on the target nodes; a missing corner gives null.

    Targets outside the source grid get no row.
    """
    found = _source_lines(cells, lon, lat, source)
    out = cells.select(lon, lat, *keys, *values)
    for name, lines, axis in ((lon, grid.nx, "lon"), (lat, grid.ny, "lat")):
        pairs = linear_axis_map(grid.axis(cells.sparkSession, axis), axis, found)
        pairs = pairs.select(
            F.col("source").alias(f"_s_{axis}"), F.col("target").alias(f"_t_{axis}"),
            F.col("weight").alias(f"_w_{axis}"), F.col("parts").alias(f"_n_{axis}"),
        )
        out = out.join(_small(pairs, lines), F.col(name) == F.col(f"_s_{axis}"))
    weight = F.col("_w_lon") * F.col("_w_lat")
    corners = F.max(F.col("_n_lon") * F.col("_n_lat"))
    return out.groupBy(F.col("_t_lon").alias(lon), F.col("_t_lat").alias(lat), *keys).agg(
        *[F.when(F.count(v) == corners, F.sum(weight * F.col(v))).alias(v) for v in values]
    )
