"""k-means with all restarts in the same passes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = "_run"


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def _held(df: DataFrame, centres: dict[int, list[list[float]]]) -> Column:
    """Centres of all runs as a constant: an array, by run, of arrays of points."""
    rows = [([centres[r] for r in sorted(centres)],)]
    return df.sparkSession.createDataFrame(rows, "c array<array<array<double>>>").scalar()


def _nearest(points: DataFrame, centres: dict[int, list[list[float]]], vector: str) -> DataFrame:
    """Rows (run, vector, best): for each run the smallest squared distance and its centre."""
    runs = F.transform(F.sequence(F.lit(0), F.lit(len(centres) - 1)), lambda r: r)
    rows = points.withColumn("_all", _held(points, centres)).withColumn(RUN, F.explode(runs)).withColumn("_own", F.get("_all", F.col(RUN))).drop("_all")
    distances = F.transform("_own", lambda c, i: F.struct(_distance(F.col(vector), c).alias("d"), i.alias("cluster")))
    return rows.withColumn("_best", F.array_min(distances)).drop("_own")


def _draw(key: Column, run: Column, step: int, seed: int) -> Column:
    """A number in (0, 1) that a row draws in a run, the same at every evaluation."""
    return (F.pmod(F.xxhash64(key, run, F.lit(step), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _start(points: DataFrame, key: str, vector: str, k: int, restarts: int, seed: int) -> dict[int, list[list[float]]]:
    """First centres of each run: drawn by squared distance from those before, one pass a centre for all runs.

    The row with the least ``-ln(u) / d2`` is a draw with chances in proportion to ``d2``.
    """
    runs = points.withColumn(RUN, F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))))
    draw = lambda step: -F.log(_draw(F.col(key), F.col(RUN), step, seed))
    first = runs.groupBy(RUN).agg(F.min_by(vector, F.struct(draw(0), F.col(key))).alias("c")).collect()
    centres = {r[RUN]: [list(r["c"])] for r in first}
    for step in range(1, k):
        far = _nearest(points, centres, vector).withColumn("_d", F.col("_best.d"))
        pick = F.when(F.col("_d") > 0, F.struct((draw(step) / F.col("_d")).alias("w"), F.col(key)))
        found = {r[RUN]: r["c"] for r in far.groupBy(RUN).agg(F.min_by(vector, pick).alias("c")).collect()}
        # Fewer different points than centres: a centre stands twice.
        centres = {r: [*c, list(found[r]) if found.get(r) is not None else c[0]] for r, c in centres.items()}
    return centres


def kmeans_restarts(points: DataFrame, key: str, vector: str, k: int, restarts: int, seed: int = 42, rounds: int = 20) -> tuple[list[list[float]], float]:
    """Centres of the best of all runs and its cost; every round is one assignment and one aggregation for all runs.

    Centres are restarts times k points, whatever the table holds. Rounds end
    when no centre of any run moves by more than a ten-thousandth.
    """
    centres = _start(points, key, vector, k, restarts, seed)
    if not centres:
        return [], 0.0
    width = len(next(iter(centres.values()))[0])
    for _ in range(rounds):
        best = _nearest(points, centres, vector)
        means = best.groupBy(RUN, F.col("_best.cluster").alias("cluster")).agg(
            F.array(*[F.avg(F.get(vector, F.lit(i))) for i in range(width)]).alias("centre")
        )
        moved = {r: list(c) for r, c in centres.items()}
        for row in means.collect():  # restarts times k
            moved[row[RUN]][row["cluster"]] = list(row["centre"])
        steps = [math.dist(a, b) for r in moved for a, b in zip(moved[r], centres[r])]
        centres = moved
        if max(steps) <= 1e-4:
            break
    cost = _nearest(points, centres, vector).groupBy(RUN).agg(F.sum("_best.d").alias("cost")).collect()
    run, least = min(((r[RUN], r["cost"]) for r in cost), key=lambda x: (x[1], x[0]))
    return centres[run], least


def assigned(points: DataFrame, centres: list[list[float]], vector: str, name: str = "cluster") -> DataFrame:
    """Add the number of the nearest centre."""
    return _nearest(points, {0: centres}, vector).withColumn(name, F.col("_best.cluster")).drop(RUN, "_best")
