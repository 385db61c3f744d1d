"""Quantile classes of predictions and ranking of model trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .ordered import dense_rank_levels, ordered_row_number


def _class_of(rank: str, of: str, quantiles: int) -> Column:
    steps, last = f"(({rank} - 1) * {quantiles})", f"greatest({of} - 1, 1)"
    # Ceiling in whole numbers: no rounding error at class borders.
    return F.expr(f"cast(greatest(1, ({steps} + {last} - 1) div {last}) as int)")


def quantile_class(df: DataFrame, score: str, group: list[str], quantiles: int, ties: list[str], name: str) -> DataFrame:
    """Equal-frequency class per group, 1 = highest scores.

    Cut points are interpolated ranks, so the class of rank r among n rows is
    ceil((r - 1) * q / (n - 1)), at least 1. Equal scores go by ``ties``, missing scores last.
    """
    by = [F.col(score).isNull(), -F.col(score), *map(F.col, ties)]
    ranked = ordered_row_number(df, group, by, "_r")
    return ranked.withColumn(name, _class_of("_r", "_r_of", quantiles)).drop("_r", "_r_of")


def quantile_classes(df: DataFrame, scores: dict[str, str], group: list[str], quantiles: int, ties: list[str]) -> DataFrame:
    """``quantile_class`` of several scores (name of the class by score), ranked together in one long pass.

    ``df`` is a written table: its rows get a number that later reads repeat. A
    narrow row per score is ranked; classes come back by that number.
    """
    numbered = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "quantile-rows")
    each = F.array(*[F.struct(F.lit(name).alias("_score"), F.col(s).cast("double").alias("_p")) for s, name in scores.items()])
    long = numbered.select("_row", *group, *[t for t in ties if t not in group], F.explode(each).alias("e")).select("*", "e._score", "e._p").drop("e")
    found = quantile_class(long, "_p", [*group, "_score"], quantiles, [*ties, "_row"], "_class")
    wide = found.groupBy("_row").agg(*[F.max(F.when(F.col("_score") == name, F.col("_class"))).alias(name) for name in scores.values()])
    return numbered.join(wide, "_row").drop("_row")


def rank_trials(trials: DataFrame, gap: str = "gap_train_test", score: str = "mean_test_score") -> DataFrame:
    """Dense ranks of the smallest gap and the highest score, and their mean.

    Missing values rank last. The best trial is the first by (mean_rank,
    score).
    """
    by_gap = dense_rank_levels(trials, gap, "rank_dif")
    by_score = dense_rank_levels(trials, score, "rank_test", descending=True)
    ranked = trials
    for levels, column, name in ((by_gap, gap, "rank_dif"), (by_score, score, "rank_test")):
        found = levels.select(F.col(column).alias("_level"), name)
        ranked = ranked.join(found, ranked[column].eqNullSafe(F.col("_level")), "left").drop("_level")
    return ranked.withColumn("mean_rank", (F.col("rank_dif") + F.col("rank_test")) / 2)


def best_trials(ranked: DataFrame, n: int = 1, score: str = "mean_test_score", tie: str = "trial_number") -> DataFrame:
    return ranked.orderBy("mean_rank", score, tie).limit(n)
