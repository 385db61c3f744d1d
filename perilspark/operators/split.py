"""Train / backtest / out-of-sample splits, as one ``subset`` column.

Splits are deterministic (hash-based), so every evaluation of the plan gives
the same subsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..session import materialise
from .columns import drop_missing
from .joins import broadcast_if_small
from .ordered import ordered_row_number, running_sums

TRAIN, BACKTEST, OUT = "train", "backtest", "out_of_sample"


def latest_slices(df: DataFrame, split: str, n: int) -> Column:
    """Array of the ``n`` highest distinct values, as a scalar subquery."""
    # n is a run parameter (months), so the array has a fixed size.
    top = df.select(split).distinct().orderBy(F.desc(split)).limit(n)
    return top.agg(F.collect_set(split)).scalar()


def slice_shares(df: DataFrame, split: str) -> DataFrame:
    """Row share per slice and its running total from the highest slice down."""
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    shares = running_sums(counts, [], split, ["n"], descending=True, value=F.col(split).cast("double"))
    return shares.select(
        split, "n", (F.col("n") / F.col("total_n")).alias("share"), (F.col("cum_n") / F.col("total_n")).alias("cum_share")
    )


def backtest_flag(df: DataFrame, split: str, n_slices: int = 0, frac_slices: float = 0.2) -> Column:
    """True on the latest ``n_slices`` slices, or on the latest slices whose
    running share stays below ``frac_slices``."""
    if n_slices > 0:
        known = df.select(split).distinct().limit(n_slices).count()
        if n_slices > known:
            raise ValueError(f"n_slices is {n_slices}, but there are only {known} slices")
        chosen = latest_slices(df, split, n_slices)
    elif 0 < frac_slices < 1:
        # Slices are months: their number is bounded by the calendar.
        chosen = slice_shares(df, split).where(F.col("cum_share") < frac_slices).agg(F.collect_set(split)).scalar()
    else:
        raise ValueError("give a positive n_slices or a frac_slices between 0 and 1")
    return F.array_contains(chosen, F.col(split))


def holdout_groups(df: DataFrame, group: str, fraction: float, stratify: str | None = None, seed: int = 42) -> DataFrame:
    """Groups held out: the first of each stratum in hash order.

    The share is rounded up over all groups; strata get their part of it rounded
    down, and what is left goes to the largest remainders, the first stratum
    by name among equals.
    """
    strata = [stratify] if stratify else []
    ranked = ordered_row_number(df.select(group, *strata).distinct(), strata, [hash_key(group, F.lit(seed)), F.col(group)], "_r")
    if not strata:
        return ranked.where(F.col("_r") <= F.ceil(F.round(F.col("_r_of") * fraction, 9))).select(group)
    # One row per stratum.
    sizes = ranked.groupBy(stratify).agg(F.max("_r_of").alias("n"))
    whole = sizes.agg(F.struct(F.ceil(F.round(F.sum("n") * fraction, 9)).alias("out"), F.sum("n").alias("n")).alias("t")).scalar()
    exact = F.col("n") * whole["out"] / whole["n"]
    quota = sizes.select(stratify, F.floor(F.round(exact, 9)).alias("q"), (exact - F.floor(F.round(exact, 9))).alias("rest"))
    line = Window.partitionBy(F.lit(1))
    left = whole["out"] - F.sum("q").over(line)
    first = F.row_number().over(line.orderBy(F.round("rest", 9).desc(), F.col(stratify)))
    quota = quota.select(F.col(stratify).alias("_stratum"), (F.col("q") + F.when(first <= left, 1).otherwise(0)).alias("_quota"))
    held = ranked.join(quota, ranked[stratify].eqNullSafe(quota["_stratum"])).where(F.col("_r") <= F.col("_quota"))
    return held.select(group).distinct()


def assign_subsets(
    df: DataFrame,
    n_months: int,
    split: str = "yearmon",
    group: str | None = None,
    fraction: float = 0.25,
    stratify: str | None = None,
    required: list[str] = (),
    seed: int = 42,
) -> DataFrame:
    """Drop incomplete rows and add ``subset``.

    Held-out groups are out of sample whatever their month; of the others the
    latest months are the backtest.
    """
    df = drop_missing(df, list(required))
    if group:
        held = materialise(holdout_groups(df, group, fraction, stratify, seed).withColumn("_out", F.lit(True)), "held-out")
        df = df.join(broadcast_if_small(held), group, "left").withColumn("_out", F.coalesce("_out", F.lit(False)))
    else:
        df = df.withColumn("_out", F.lit(False))
    late = backtest_flag(df.where(~F.col("_out")), split, n_months)
    subset = F.when(F.col("_out"), OUT).when(late, BACKTEST).otherwise(TRAIN)
    return df.withColumn("subset", subset).drop("_out")


def shuffle_folds(df: DataFrame, group: str, folds: int = 4, test_fraction: float = 0.25, seed: int = 42) -> DataFrame:
    """Groups drawn as test groups per fold: (fold, group); folds may overlap.

    Groups are months, so a fold's window is bounded by the calendar.
    """
    months = df.select(group).distinct()
    per_fold = months.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    fold = Window.partitionBy("fold")
    order = fold.orderBy(hash_key(group, "fold", F.lit(seed)), group)
    ranked = per_fold.withColumns({"_r": F.row_number().over(order), "_n": F.count(F.lit(1)).over(fold)})
    return ranked.where(F.col("_r") <= F.ceil(F.col("_n") * test_fraction)).select("fold", group)


