"""Exact k nearest neighbours between arbitrary point tables.

For points on a regular grid use ``grid.match_to_grid``. Here the sample
points are counted in a hierarchy of square cells; every target walks down
from the root, keeping only the cells that can still hold one of its k nearest
points. Work per target depends on k and not on how the points cluster, and no
pair of far-apart points is ever formed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

STEP = 2  # levels per descent: 16 children per cell
MAX_LEVEL = 24
LEAF_POINTS = 32  # stop refining once no cell holds more points than this


def _cell(value: Column, origin: float, side: float, level: int) -> Column:
    top = F.lit(2**level - 1)
    return F.least(F.floor((value - origin) / F.lit(side / 2**level)), top).cast("long")


def _gap(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low - value, value - high, F.lit(0.0))


def nearest_points(
    targets: DataFrame,
    samples: DataFrame,
    k: int = 1,
    target_coords: tuple[str, str] = ("lon", "lat"),
    sample_coords: tuple[str, str] = ("lon", "lat"),
) -> DataFrame:
    """The k nearest sample points of every distinct target point.

    Distances are Euclidean in degrees; ties go to the lower (lat, lon).
    Returns target_lon, target_lat, lon, lat, distance, rank.
    """
    t_lon, t_lat = target_coords
    s_lon, s_lat = sample_coords
    points = samples.select(F.col(s_lon).cast("double").alias("lon"), F.col(s_lat).cast("double").alias("lat"))
    # Written once: every level below reads the distinct points again.
    points = materialise(points.na.drop().distinct(), "sample-points")
    places = targets.select(F.col(t_lon).cast("double").alias("tx"), F.col(t_lat).cast("double").alias("ty"))
    places = places.na.drop().distinct()

    span = points.agg(F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat"), F.count(F.lit(1))).first()
    if span[0] is None:
        raise ValueError("there are no sample points")
    x0, y0 = span[0], span[2]
    side = max(span[1] - x0, span[3] - y0) or 1.0
    cells, level = _cells(points, x0, y0, side, span[4])

    finest = {"cx": _cell(F.col("lon"), x0, side, MAX_LEVEL), "cy": _cell(F.col("lat"), y0, side, MAX_LEVEL)}
    points = points.withColumns({name: F.shiftright(c, MAX_LEVEL - level) for name, c in finest.items()})
    # The 16 cells of the first level by arithmetic; from there on a cell's children come by its number.
    child = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4**STEP - 1).cast("long")))
    frontier = places.withColumn("child", child).select("tx", "ty", (F.col("child") % 2**STEP).alias("cx"), F.shiftright("child", STEP).alias("cy"))
    for at in range(STEP, level + 1, STEP):
        own = cells.where(F.col("level") == at).drop("level")
        # At shallow levels a table of all possible cells is provably small.
        small = (lambda df: F.broadcast(df)) if 4**at <= 65_536 else (lambda df: df)
        if at == STEP:
            down = frontier.join(small(own), ["cx", "cy"])
        else:
            parents = own.withColumns({"px": F.shiftright("cx", STEP), "py": F.shiftright("cy", STEP)})
            down = frontier.withColumnsRenamed({"cx": "px", "cy": "py"}).join(small(parents), ["px", "py"])
        frontier = _prune(down, k, x0, y0, side / 2**at).select("tx", "ty", "cx", "cy")

    pairs = frontier.join(points, ["cx", "cy"])
    distance = F.sqrt(F.pow(F.col("lon") - F.col("tx"), 2) + F.pow(F.col("lat") - F.col("ty"), 2))
    order = Window.partitionBy("tx", "ty").orderBy(F.round("distance", 12), "lat", "lon")
    ranked = pairs.withColumn("distance", distance).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select(
        F.col("tx").alias("target_lon"), F.col("ty").alias("target_lat"), "lon", "lat", "distance", "rank"
    )


def _cells(points: DataFrame, x0: float, y0: float, side: float, n: int) -> tuple[DataFrame, int]:
    """Counts of the non-empty cells of all levels, written in one pass, and the level at which the search ends.

    That is the shallowest one that could and does hold few points in its fullest cell.
    """
    least = min(MAX_LEVEL, max(STEP, STEP * math.ceil(math.log(max(n / LEAF_POINTS, 1), 4) / STEP)))
    finest = {"cx": _cell(F.col("lon"), x0, side, MAX_LEVEL), "cy": _cell(F.col("lat"), y0, side, MAX_LEVEL)}
    rows = points.select(*[c.alias(name) for name, c in finest.items()]).withColumn("level", F.explode(F.sequence(F.lit(STEP), F.lit(MAX_LEVEL), F.lit(STEP))))
    rows = rows.select("level", *[F.expr(f"shiftright({c}, {MAX_LEVEL} - level)").alias(c) for c in ("cx", "cy")])
    cells = materialise(rows.groupBy("level", "cx", "cy").agg(F.count(F.lit(1)).alias("n")), "sample-cells")
    fits = cells.where(F.col("level") >= least).groupBy("level").agg(F.max("n").alias("most")).where(F.col("most") <= LEAF_POINTS)
    return cells, fits.agg(F.min("level")).first()[0] or MAX_LEVEL


def _prune(frontier: DataFrame, k: int, x0: float, y0: float, side: float) -> DataFrame:
    """Keep cells whose near corner is within reach of the k-th best bound."""
    x, y = F.col("tx"), F.col("ty")
    left, bottom = F.col("cx") * side + x0, F.col("cy") * side + y0
    near = F.sqrt(F.pow(_gap(x, left, left + side), 2) + F.pow(_gap(y, bottom, bottom + side), 2))
    dx = F.greatest(F.abs(x - left), F.abs(x - left - side))
    dy = F.greatest(F.abs(y - bottom), F.abs(y - bottom - side))
    far = F.sqrt(dx * dx + dy * dy)
    place = Window.partitionBy("tx", "ty")
    by_far = place.orderBy("far").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = frontier.withColumns({"near": near, "far": far}).withColumn("held", F.sum("n").over(by_far))
    reach = F.min(F.when(F.col("held") >= k, F.col("far"))).over(place)
    bounded = held.withColumn("reach", reach)
    # A slack of 1e-9 degrees covers rounding of cell corners.
    return bounded.where(F.col("reach").isNull() | (F.col("near") <= F.col("reach") + 1e-9))
