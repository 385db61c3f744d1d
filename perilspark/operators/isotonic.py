"""Isotonic regression over any number of points: violators are pooled range by range, then across ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from .ordered import ordered_row_number, with_place

#: Neighbouring blocks that one step pools together.
RANGE = 128
#: Blocks that the driver merges at last, at most.
LAST = 20_000

_BLOCK = "struct<low double, high double, total double, weight double>"


def _pool(blocks: Column) -> Column:
    """Pool adjacent violators of a sorted array of blocks; the result is a stack with rising means."""

    def joined(a: Column, b: Column) -> Column:
        return F.struct(
            F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"),
            (a["total"] + b["total"]).alias("total"), (a["weight"] + b["weight"]).alias("weight"),
        )

    def violates(a: Column, b: Column) -> Column:
        return a["total"] * b["weight"] >= b["total"] * a["weight"]

    def push(stack: Column, block: Column) -> Column:
        # From the top down: as long as a block violates, it joins the one that is being pushed.
        start = F.struct(block.alias("top"), F.lit(0).alias("taken"), F.lit(False).alias("done"))

        def take(state: Column, under: Column) -> Column:
            goes_on = ~state["done"] & violates(under, state["top"])
            return F.struct(
                F.when(goes_on, joined(under, state["top"])).otherwise(state["top"]).alias("top"),
                (state["taken"] + F.when(goes_on, 1).otherwise(0)).alias("taken"), (~goes_on).alias("done"),
            )

        end = F.aggregate(F.reverse(stack), start, take)
        return F.concat(F.slice(stack, F.lit(1), F.size(stack) - end["taken"]), F.array(end["top"]))

    return F.aggregate(blocks, F.array().cast(f"array<{_BLOCK}>"), push)


def _merged(rows: list) -> list[tuple]:
    """The same for blocks on the driver, in order."""
    stack: list[tuple] = []
    for low, high, total, weight in rows:
        while stack and stack[-1][2] * weight >= total * stack[-1][3]:
            a = stack.pop()
            low, total, weight = a[0], a[2] + total, a[3] + weight
        stack.append((low, high, total, weight))
    return stack


def pooled_blocks(points: DataFrame, x: str, total: str, weight: str, last: int = LAST, size: int = RANGE) -> list[tuple]:
    """Blocks (low, high, total, weight) of the isotonic fit, in order.

    ``points`` has one row per ``x`` with the sum of labels and of weights.
    Ranges of neighbouring blocks are pooled side by side in tasks, and again
    with ranges shifted by half, until few are left or nothing changes:
    pooling in any order gives the same fit. What is left is merged on the driver.
    """
    blocks = points.select(F.col(x).cast("double").alias("low"), F.col(x).cast("double").alias("high"), F.col(total).cast("double").alias("total"), F.col(weight).cast("double").alias("weight"))
    blocks = materialise(blocks, "isotonic")
    count, still, shift = blocks.count(), 0, 0
    while count > last and still < 2:
        ranked = ordered_row_number(blocks, [], [F.col("low")], "_r")
        ranges = ranked.groupBy(F.floor((F.col("_r") + shift) / size).alias("_g")).agg(F.sort_array(F.collect_list(F.struct("low", "high", "total", "weight"))).alias("b"))
        blocks = materialise(ranges.select(F.inline(_pool(F.col("b").cast(f"array<{_BLOCK}>")))), "isotonic")
        before, count, shift = count, blocks.count(), size // 2 - shift
        still = still + 1 if count == before else 0
    return _merged([tuple(r) for r in blocks.orderBy("low").select("low", "high", "total", "weight").collect()])


@dataclass(frozen=True)
class StepCalibration:
    """A rising curve through points, straight between them and flat outside."""

    bounds: list[float]
    values: list[float]

    @classmethod
    def of_blocks(cls, blocks: list[tuple]) -> StepCalibration:
        bounds, values = [], []
        for low, high, total, weight in blocks:
            for at in (low, high) if high > low else (low,):
                bounds.append(at)
                values.append(total / weight)
        return cls(bounds, values)

    def transform(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """Add ``name``, the curve at ``column``; null stays null."""
        spark, n = df.sparkSession, len(self.bounds)
        held = spark.createDataFrame([(self.bounds, self.values)], "b array<double>, v array<double>")
        curve = held.select(F.struct("b", "v").alias("s")).scalar()
        placed = df.withColumns({"_curve_b": curve["b"], "_curve_v": curve["v"]})
        placed = with_place(placed, column, "_curve_b", n, "_curve_at")
        at, p = F.col("_curve_at"), F.col(column)
        x1, y1 = F.get("_curve_b", at), F.get("_curve_v", at)
        x0, y0 = F.get("_curve_b", at - 1), F.get("_curve_v", at - 1)
        value = (
            F.when(p.isNull(), None).when((at == 0) | (x1 == p), y1).when(at >= n, y0)
            .otherwise(y0 + (y1 - y0) * (p - x0) / (x1 - x0))
        )
        # A generator keeps later filters from repeating the search.
        return placed.select(*df.columns, F.explode(F.array(value)).alias(name))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.bounds, self.values)], "b array<double>, v array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StepCalibration:
        row = spark.read.parquet(path).first()
        return cls(list(row["b"]), list(row["v"]))


def fit_isotonic(rows: DataFrame, x: str, label: str, **options) -> StepCalibration:
    """Isotonic fit of a label on a score; rows collapse to one point per score first."""
    known = rows.where(F.col(x).isNotNull() & F.col(label).isNotNull())
    points = known.groupBy(F.col(x).alias("x")).agg(F.sum(F.col(label).cast("double")).alias("s"), F.count(F.lit(1)).alias("n"))
    return StepCalibration.of_blocks(pooled_blocks(points, "x", "s", "n", **options))
