"""Point-in-polygon joins on plain columns.

A polygon is a row with ``edges array<struct<x1,y1,x2,y2>>`` and its bounding
box. Rings of holes and of multi-polygons are simply further edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import snap_bounds
from ..session import materialise
from .columns import include_exclude
from .grid import padded_id, total_bounds
from .joins import broadcast_if_small
from .ordered import ordered_row_number

#: Tiles start at this part of a cell, so that round coordinates fall on no tile side.
SHIFT = 0.3819660112501051

EDGES = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")]))


def with_bounds(polygons: DataFrame) -> DataFrame:
    """Add minx, miny, maxx, maxy from the edges."""
    xs, ys = (F.transform("edges", lambda e: e["x1"]), F.transform("edges", lambda e: e["y1"]))
    return polygons.withColumns(
        {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}
    )


def edges_of_ring(ring: Column) -> Column:
    """Edges of an ``array<struct<x,y>>`` ring that closes itself."""

    def edge(p, q):
        return F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))

    # Zipped with itself moved by one corner: a ring named inside a lambda would be built again for every corner.
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), edge)


def polygons_from_rings(spark: SparkSession, attributes: list[str], rows: list[tuple]) -> DataFrame:
    """Small polygon table from (attribute..., ring) rows; rings close themselves."""
    schema = T.StructType([T.StructField(a, T.StringType()) for a in attributes] + [T.StructField("edges", EDGES)])

    def edges(ring):
        closed = [*ring[1:], ring[0]]
        return [tuple(map(float, (*a, *b))) for a, b in zip(ring, closed)]

    return with_bounds(spark.createDataFrame([(*row[:-1], edges(row[-1])) for row in rows], schema))


def box_polygon(spark: SparkSession, minx: float, miny: float, maxx: float, maxy: float, location_id: str = "ID-000") -> DataFrame:
    ring = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy)]
    return polygons_from_rings(spark, ["location_id"], [(location_id, ring)])


def outline(edges: Column | str) -> Column:
    """Canonical form of a shape: its edges without direction, in order.

    Rings that differ in starting corner or direction, and shapes that list
    their rings in another order, have the same outline. Edges of no length
    are left out. A corner added half-way along an edge makes another outline.
    """

    def undirected(e):
        a, b = F.struct(e["x1"].alias("x"), e["y1"].alias("y")), F.struct(e["x2"].alias("x"), e["y2"].alias("y"))
        return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))

    return F.sort_array(F.filter(F.transform(edges, undirected), lambda e: e["a"] != e["b"]))


def distinct_areas(polygons: DataFrame) -> DataFrame:
    """One row per shape: that with the smallest other columns, in their order (missing first).

    Shapes meet by a 128-bit hash of their outline; partial aggregation keeps
    one row of equal shapes per task, however often a shape occurs.
    """
    form = outline("edges")
    keyed = polygons.withColumns({"_shape": F.xxhash64(form), "_shape2": F.xxhash64(F.lit("outline"), form)})
    others = [c for c in polygons.columns if c != "edges"]
    first = keyed.groupBy("_shape", "_shape2").agg(F.min(F.struct(*others, "edges")).alias("_row"))
    return first.select(*[F.col(f"_row.{c}").alias(c) for c in polygons.columns], "_shape", "_shape2")


def number_areas(polygons: DataFrame, name: str = "location_id") -> DataFrame:
    """Distinct shapes numbered ``ID-001…`` by their north-western corner, then by their other sides and outline."""
    corner = [F.col("minx"), -F.col("maxy"), F.col("maxx"), F.col("miny"), F.col("_shape"), F.col("_shape2")]
    numbered = ordered_row_number(distinct_areas(polygons), [], corner, "_i")
    return numbered.withColumn(name, padded_id(F.col("_i"), F.col("_i_of"))).drop("_i", "_i_of", "_shape", "_shape2")


def area_of_interest(
    spark: SparkSession,
    polygons: DataFrame | None = None,
    bounds: dict[str, float] | None = None,
    include: dict[str, list] | None = None,
    exclude: dict[str, list] | None = None,
    parts: int = 10,
) -> tuple[dict[str, float], DataFrame]:
    """Bounds grown to 1/parts degree, and the area's polygons with ids.

    Given ``bounds`` make one box; otherwise the selected polygons count, and
    an empty selection is an error.
    """
    if bounds is not None:
        grown = snap_bounds(**bounds, parts=parts)
        return grown, box_polygon(spark, **grown)
    if polygons is None:
        raise ValueError("give polygons or bounds")
    chosen = include_exclude(number_areas(polygons), include, exclude)
    return snap_bounds(**total_bounds(chosen), parts=parts), chosen


def _x_at(e, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * F.try_divide(y - e["y1"], e["y2"] - e["y1"]) + e["x1"]


def _contains(x: Column, y: Column, edges: Column, odd: Column, east: Column, south: Column) -> Column:
    """Even-odd test: left and bottom borders are in, right and top out.

    The ray to the east is followed inside the tile only: along the point's
    latitude to the tile's east side and down that side to its lower corner,
    whose own ray crosses the outline ``odd`` times (modulo 2).
    """

    def across(e):
        at = _x_at(e, y)
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < at) & (at <= east)

    def down(e):
        height = (e["y2"] - e["y1"]) * F.try_divide(east - e["x1"], e["x2"] - e["x1"]) + e["y1"]
        rising = (e["y1"] != e["y2"]) & ((e["y2"] > e["y1"]) == (e["x2"] > e["x1"]))
        below = lambda v: (height < v) | ((height == v) & ~rising)
        return ((e["x1"] > east) != (e["x2"] > east)) & (below(y) != below(south))

    crossings = F.size(F.filter(edges, across)) + F.size(F.filter(edges, down))
    return (odd + F.when(edges.isNull(), 0).otherwise(crossings)) % 2 == 1


def polygon_tiles(polygons: DataFrame, attributes: list[str], cell: float = 0.5) -> DataFrame:
    """Square tiles that polygons cover: ``_px, _py, _odd, _edges`` and attributes.

    A tile holds the edges that cross it and the parity of the outline east
    of its lower right corner, a running sum along its row. Rows grow with
    edges plus tiles; tiles outside a polygon are left out.
    """
    bounds = ["minx", "miny", "maxx", "maxy"]
    shapes = polygons.select(F.xxhash64(*attributes, "edges").alias("_id"), "edges", *bounds, *[F.col(a).alias(f"_a_{a}") for a in attributes])
    # Equal rows are one shape with copies; their edges must not meet.
    shapes = shapes.groupBy("_id").agg(F.count(F.lit(1)).alias("_copies"), *[F.any_value(c).alias(c) for c in shapes.columns if c != "_id"])
    index = lambda v: F.floor((v - cell * SHIFT) / cell)
    span = lambda a, b: F.explode(F.sequence(index(a), index(b)))
    slack = 1e-9

    edge = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
    bands = shapes.select("_id", F.explode("edges").alias("_e")).select("_id", "_e.*")
    bands = bands.withColumn("_py", span(F.least("y1", "y2") - slack, F.greatest("y1", "y2") + slack))
    south = (F.col("_py") + SHIFT) * cell
    inside = [F.greatest(south, F.least(south + cell, edge[c])) for c in ("y1", "y2")]
    ends = [F.coalesce(_x_at(edge, y), edge[c]) for y, c in zip(inside, ("x1", "x2"))]
    local = bands.withColumn("_px", span(F.least(*ends) - slack, F.greatest(*ends) + slack))
    local = local.groupBy("_id", "_px", "_py").agg(F.collect_list(F.struct(*edge)).alias("_edges"))

    last = F.ceil((_x_at(edge, south) - cell * SHIFT) / cell) - 2
    crossed = bands.where((edge["y1"] > south) != (edge["y2"] > south)).select("_id", last.alias("_px"), "_py", F.lit(1).alias("_n"))
    frame = shapes.select("_id", span(F.col("minx"), F.col("maxx")).alias("_px"), "miny", "maxy")
    frame = frame.select("_id", "_px", span(F.col("miny"), F.col("maxy")).alias("_py"), F.lit(0).alias("_n"))
    counts = frame.unionByName(crossed).groupBy("_id", "_px", "_py").agg(F.sum("_n").alias("_n"))
    row = Window.partitionBy("_id", "_py").orderBy(F.desc("_px")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_odd", F.sum("_n").over(row) % 2).drop("_n")

    tiles = counts.join(local, ["_id", "_px", "_py"], "left").where((F.col("_odd") == 1) | F.col("_edges").isNotNull())
    about = shapes.select("_id", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"), *[c for c in shapes.columns if c not in ("_id", "edges", "_copies")])
    return tiles.join(about, "_id").drop("_id", "_copy").withColumnsRenamed({b: f"_{b}" for b in bounds})


def polygon_join(
    points: DataFrame,
    polygons: DataFrame,
    attributes: list[str],
    how: str = "inner",
    lon: str = "lon",
    lat: str = "lat",
    cell: float = 0.5,
) -> DataFrame:
    """Attach the attributes of every polygon that contains the point.

    Both sides meet on square tiles, an equi-join: the tiles are written once
    and broadcast if their counted edges are few, otherwise both sides shuffle
    by tile and AQE splits crowded ones.
    """
    return tile_join(points, materialise(polygon_tiles(polygons, attributes, cell), "polygon-tiles"), attributes, how, lon, lat, cell)


def tile_join(
    points: DataFrame,
    tiles: DataFrame,
    attributes: list[str],
    how: str = "inner",
    lon: str = "lon",
    lat: str = "lat",
    cell: float = 0.5,
) -> DataFrame:
    """``polygon_join`` on tiles that were written already."""
    tiles = broadcast_if_small(tiles, F.coalesce(F.size("_edges"), F.lit(0)) + 1)
    x, y = F.col(lon), F.col(lat)
    index = lambda v: F.floor((v - cell * SHIFT) / cell)
    placed = points.withColumns({"_cx": index(x), "_cy": index(y)})
    east, south = (F.col("_px") + 1 + SHIFT) * cell, (F.col("_py") + SHIFT) * cell
    match = (
        (F.col("_cx") == F.col("_px"))
        & (F.col("_cy") == F.col("_py"))
        & x.between(F.col("_minx"), F.col("_maxx"))
        & y.between(F.col("_miny"), F.col("_maxy"))
        & _contains(x, y, F.col("_edges"), F.col("_odd"), east, south)
    )
    return placed.join(tiles, match, how).select(*points.columns, *[F.col(f"_a_{a}").alias(a) for a in attributes])
