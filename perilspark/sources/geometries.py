"""Polygon tables: whole shapes for selection, tiles for joins, both pruned by bounds.

``shapes`` has a row per polygon with its box; ``tiles`` what ``polygon_tiles``
makes of it, so that a join reads the tiles near its points only and no task
holds a whole outline. Rows are sorted along longitude inside blocks of
``BLOCK`` degrees, so that Parquet's statistics skip what lies outside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spatial import SHIFT, polygon_tiles, tile_join, with_bounds
from .tables import read_table

BLOCK = 10  # degrees
BOX = ["minx", "miny", "maxx", "maxy"]


def _block(x: Column | str) -> Column:
    return F.floor((F.col(x) if isinstance(x, str) else x) / BLOCK).cast("int")


def write_polygons(polygons: DataFrame, path: str, cell: float = 0.5) -> None:
    """Write shapes and tiles; every column but ``edges`` and the box is an attribute.

    The box is taken from the edges. A polygon without edges is kept among the
    shapes (with a missing box) and has no tiles. A rerun replaces the table.
    """
    attributes = [c for c in polygons.columns if c not in ("edges", *BOX)]
    boxed = with_bounds(polygons)
    _write(boxed.withColumn("block", _block("minx")), "minx", f"{path}/shapes")
    tiles = polygon_tiles(boxed.where(F.size("edges") > 0), attributes, cell).withColumn("_cell", F.lit(float(cell)))
    _write(tiles.withColumn("block", _block((F.col("_px") + SHIFT) * cell)), "_px", f"{path}/tiles")


def _write(df: DataFrame, order: str, path: str) -> None:
    placed = df.hint("rebalance", "block").sortWithinPartitions("block", order)
    placed.write.mode("overwrite").option("compression", "zstd").partitionBy("block").parquet(path)


def _scan(spark: SparkSession, path: str, schema_of: str) -> DataFrame:
    try:
        return read_table(spark, f"{path}/{schema_of}")
    except FileNotFoundError as error:
        raise FileNotFoundError(f"no polygon table at {path}") from error


def read_polygons(spark: SparkSession, path: str, bounds: dict[str, float] | None = None) -> DataFrame:
    """Whole polygons; with ``bounds`` those whose box meets them, borders included."""
    shapes = _scan(spark, path, "shapes")
    if bounds is not None:
        meets = (F.col("maxx") >= bounds["minx"]) & (F.col("maxy") >= bounds["miny"]) & (F.col("miny") <= bounds["maxy"])
        # A box may begin in any block to the west, in none to the east.
        shapes = shapes.where(meets & (F.col("minx") <= bounds["maxx"]) & (F.col("block") <= _block(F.lit(bounds["maxx"]))))
    return shapes.drop("block")


def read_tiles(spark: SparkSession, path: str, bounds: dict[str, float] | None = None) -> tuple[DataFrame, float]:
    """Tiles, with ``bounds`` those that meet them, and the tiles' width."""
    tiles = _scan(spark, path, "tiles")
    first = tiles.select("_cell").first()
    cell = first["_cell"] if first else 0.5
    if bounds is not None:
        low, high = F.lit(bounds["minx"]), F.lit(bounds["maxx"])
        index = lambda v: F.floor((v - cell * SHIFT) / cell)
        tiles = tiles.where(
            F.col("block").between(_block(low - cell), _block(high))
            & F.col("_px").between(index(low), index(high))
            & F.col("_py").between(index(F.lit(bounds["miny"])), index(F.lit(bounds["maxy"])))
        )
    return tiles.drop("_cell", "block"), cell


def join_polygons(
    points: DataFrame,
    path: str,
    attributes: list[str],
    how: str = "inner",
    bounds: dict[str, float] | None = None,
    lon: str = "lon",
    lat: str = "lat",
) -> DataFrame:
    """Attach attributes of the stored polygons that hold a point.

    ``bounds`` must hold all points that are to be matched; a point outside
    them may find nothing.
    """
    tiles, cell = read_tiles(points.sparkSession, path, bounds)
    return tile_join(points, tiles, attributes, how, lon, lat, cell)
