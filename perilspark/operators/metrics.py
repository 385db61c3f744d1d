"""Evaluation metrics as aggregates, for any number of groups at once.

Rows collapse to (group, score level) counts first; cumulative counts then run
over score buckets (``ordered.running_sums``). Nothing sorts all rows of one
group in one task, and no metric needs a Python function.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running_sums


def _sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def score_curve(
    df: DataFrame, label: str, score: str, keys: list[str] = (), buckets: int | None = None, rows: str | None = None
) -> DataFrame:
    """One row per group and distinct score with cumulative class counts.

    pos, neg at the level; cum_* at or below it; total_* of the group. ``rows``
    names the column that says for how many rows one stands.
    """
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    each = F.lit(1) if rows is None else F.col(rows)
    counts = [F.sum(F.when(c, each).otherwise(0)).alias(n) for n, c in (("pos", F.col(label) == 1), ("neg", F.col(label) != 1))]
    levels = known.groupBy(*keys, score).agg(*counts)
    return running_sums(levels, list(keys), score, ["pos", "neg"], buckets=buckets)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def curve_metrics(
    curve: DataFrame, keys: list[str] = (), target_recall: float = 0.8, score: str | None = None, threshold: float = 0.5
) -> DataFrame:
    """AUC, Gini, KS and best precision at a recall, from one pass over levels.

    With ``score`` also F1 and recall of the rule "score > threshold": a sum
    over the same levels. A group with a single class has no AUC and KS (null).
    """
    pos, neg, total_pos, total_neg = (F.col(c) for c in ("pos", "neg", "total_pos", "total_neg"))
    below = F.col("cum_neg") - neg
    wins = F.sum(pos.cast("double") * (below + neg / 2))
    gap = F.abs(F.try_divide(F.col("cum_pos"), total_pos) - F.try_divide(F.col("cum_neg"), total_neg))
    hits, false_hits = total_pos - F.col("cum_pos") + pos, total_neg - F.col("cum_neg") + neg
    precision = F.try_divide(hits, hits + false_hits)
    enough = F.try_divide(hits, total_pos) >= target_recall
    wanted = {
        "auc": F.try_divide(wins, F.max(total_pos).cast("double") * F.max(total_neg)),
        "ks": F.max(gap),
        "precision_at_recall": F.coalesce(F.max(F.when(enough, precision)), F.lit(0.0)),
    }
    if score is not None:
        chosen = F.col(score) > threshold
        tp, fp = (F.sum(F.when(chosen, c).otherwise(0)) for c in (pos, neg))
        wanted |= {"f1": ratio(2 * tp, F.sum(pos) + tp + fp), "recall": ratio(tp, F.sum(pos))}
    out = curve.groupBy(*keys).agg(*[c.alias(name) for name, c in wanted.items()])
    return out.withColumn("gini", 2 * F.col("auc") - 1)


def auc(df: DataFrame, label: str, score: str, keys: list[str] = (), rows: str | None = None) -> DataFrame:
    return curve_metrics(score_curve(df, label, score, keys, rows=rows), keys).select(*keys, "auc", "gini")


def ks_statistic(df: DataFrame, label: str, score: str, keys: list[str] = ()) -> DataFrame:
    return curve_metrics(score_curve(df, label, score, keys), keys).select(*keys, "ks")


def precision_at_recall(df: DataFrame, label: str, score: str, recall: float = 0.8, keys: list[str] = ()) -> DataFrame:
    return curve_metrics(score_curve(df, label, score, keys), keys, recall).select(*keys, "precision_at_recall")


def long_scores(df: DataFrame, scores: dict, name: str, keys: list[str] = ()) -> DataFrame:
    """Rows (keys, name, y, p), one per row and score: several scores share one scan, one exchange and one curve.

    ``scores`` gives a label (a condition or a 0/1 column) and a score per name.
    """
    rows = F.array(*[F.struct(F.lit(n).alias(name), y.cast("int").alias("y"), p.cast("double").alias("p")) for n, (y, p) in scores.items()])
    return df.select(*keys, F.explode(rows).alias("r")).select(*keys, f"r.{name}", "r.y", "r.p")


def one_vs_rest(df: DataFrame, label: str, scores: dict[int, str], keys: list[str] = (), rows: str | None = None) -> DataFrame:
    """AUC, Gini and KS per class and their plain average per group."""
    carried = [*keys] if rows is None else [*keys, rows]
    long = long_scores(df, {c: (F.col(label) == c, F.col(s)) for c, s in scores.items()}, "cls", carried)
    per_class = curve_metrics(score_curve(long, "y", "p", [*keys, "cls"], rows=rows), [*keys, "cls"])
    return per_class.groupBy(*keys).agg(F.avg("auc").alias("auc"), F.avg("gini").alias("gini"), F.avg("ks").alias("ks"))


def label_metrics(df: DataFrame, label: str, predicted: str, classes: Sequence[int], keys: list[str] = ()) -> DataFrame:
    """Precision, recall, F1 and Jaccard of predicted labels.

    Two classes: of class 1. More: the plain average over classes.
    """
    y, p = F.col(label), F.col(predicted)
    counts = df.groupBy(*keys).agg(
        *[
            c.alias(f"{name}_{k}")
            for k in classes
            for name, c in (("tp", _sum_if((y == k) & (p == k))), ("fp", _sum_if((y != k) & (p == k))), ("fn", _sum_if((y == k) & (p != k))))
        ]
    )
    used = [1] if len(classes) == 2 else list(classes)

    def average(metric) -> Column:
        return sum((metric(*(F.col(f"{n}_{k}") for n in ("tp", "fp", "fn"))) for k in used), F.lit(0.0)) / len(used)

    return counts.select(
        *keys,
        average(lambda tp, fp, fn: ratio(tp, tp + fp)).alias("precision"),
        average(lambda tp, fp, fn: ratio(tp, tp + fn)).alias("recall"),
        average(lambda tp, fp, fn: ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        average(lambda tp, fp, fn: ratio(tp, tp + fp + fn)).alias("jaccard"),
    )


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Per-group tables side by side; without groups both are one row."""
    one = F.lit(1)
    if not keys:
        left, right = left.withColumn("_one", one), right.withColumn("_one", one)
        return left.join(right, "_one").drop("_one")
    return left.join(right, keys)


def binary_metrics(
    df: DataFrame, label: str, score: str, keys: list[str] = (), threshold: float = 0.5, target_recall: float = 0.25
) -> DataFrame:
    """AUC, GINI, KS, F1, REC and PR per group, as shares."""
    curve = score_curve(df, label, score, keys)
    names = {"auc": "AUC", "gini": "GINI", "ks": "KS", "f1": "F1", "recall": "REC", "precision_at_recall": "PR"}
    found = curve_metrics(curve, keys, target_recall, score, threshold)
    return found.select(*keys, *[F.col(c).alias(n) for c, n in names.items()])


def metric_rows(wide: DataFrame, keys: list[str], metrics: Sequence[str], value: str = "value") -> DataFrame:
    """Wide metric columns as (keys, metric, value) rows."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return wide.select(*keys, F.explode(pairs).alias("m")).select(*keys, "m.metric", F.col("m.value").alias(value))


def classification_report(df: DataFrame, label: str, score: str, subset: str, subsets: Sequence[str]) -> DataFrame:
    """Percent metrics, one row per metric and one column per subset."""
    m = binary_metrics(df, label, score, [subset])
    percent = {c: F.round(c, 4) * 100 for c in ("AUC", "KS", "F1", "REC")}
    shown = m.withColumns(percent).withColumns({"GINI": 2 * F.col("AUC") - 100, "PR": F.round(F.col("PR") * 100)})
    return side_by_side(metric_rows(shown, [subset], ["AUC", "GINI", "KS", "F1", "REC", "PR"]), subset, subsets)


def multiclass_report(
    df: DataFrame, label: str, predicted: str, scores: dict[int, str], subset: str, subsets: Sequence[str]
) -> DataFrame:
    """Percent metrics of labels and class probabilities per subset."""
    curves = one_vs_rest(df, label, scores, [subset])
    labels = label_metrics(df, label, predicted, sorted(scores), [subset])
    both = curves.join(labels, subset)
    names = {"auc": "AUC", "ks": "KS", "precision": "PREC", "recall": "RECALL", "f1": "F1", "jaccard": "JACCARD"}
    shown = both.select(subset, *[(F.round(c, 4) * 100).alias(n) for c, n in names.items()])
    shown = shown.withColumn("GINI", 2 * F.col("AUC") - 100)
    return side_by_side(metric_rows(shown, [subset], ["AUC", "GINI", "KS", "PREC", "RECALL", "F1", "JACCARD"]), subset, subsets)


def side_by_side(rows: DataFrame, subset: str, subsets: Sequence[str]) -> DataFrame:
    return rows.groupBy("metric").pivot(subset, list(subsets)).agg(F.first("value"))


METRICS = ("AUC", "GINI", "KS", "F1", "REC", "PR")


def metric_by_group(df: DataFrame, label: str, score: str, keys: list[str], metric: str) -> DataFrame:
    """One chosen metric per group, in percent; an unknown name is an error."""
    name = metric.upper()
    if name not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {METRICS}")
    return binary_metrics(df, label, score, keys).select(*keys, (F.col(name) * 100).alias("metric"))


def exact_median(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """Median per group from level counts (mean of the two middle values)."""
    keys = list(keys)
    known = df.where(F.col(value).isNotNull())
    levels = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    placed = running_sums(levels, keys, value, ["n"])
    total, upto = F.col("total_n"), F.col("cum_n")
    low = F.min(F.when(upto * 2 >= total, F.col(value)))
    high = F.min(F.when(upto * 2 >= total + F.when(total % 2 == 0, 2).otherwise(1), F.col(value)))
    return placed.groupBy(*keys).agg(((low + high) / 2).alias("median"))


def regression_metrics(df: DataFrame, label: str, predicted: str, keys: list[str] = ()) -> DataFrame:
    """R2, RMSE, MAE, MEAE (median absolute error) and MAXE per group."""
    keys = list(keys)
    known = df.where(F.col(label).isNotNull() & F.col(predicted).isNotNull())
    errors = known.withColumn("_e", F.abs(F.col(label) - F.col(predicted)))
    e = F.col("_e")
    sums = errors.groupBy(*keys).agg(
        (1 - F.try_divide(F.avg(e * e), F.var_pop(label))).alias("R2"),
        F.sqrt(F.avg(e * e)).alias("RMSE"), F.avg(e).alias("MAE"), F.max(e).alias("MAXE"),
    )
    middle = exact_median(errors, "_e", keys).withColumnRenamed("median", "MEAE")
    return _joined(sums, middle, keys).select(*keys, "R2", "RMSE", "MAE", "MEAE", "MAXE")


def threshold_sweep(df: DataFrame, label: str, score: str, keys: list[str] = (), steps: int = 100) -> DataFrame:
    """Confusion counts and rates at evenly spaced thresholds from 0 to 1.

    A row counts as predicted at a threshold if its score is strictly above
    it. Rows collapse to at most ``steps + 1`` bins per group in one pass.
    """
    keys = list(keys)
    width = 1.0 / (steps - 1)

    def at(i: Column) -> Column:
        return F.when(i == steps - 1, 1.0).otherwise(i * F.lit(width))

    p = F.col(score)
    guess = F.least(F.greatest(F.ceil(p * (steps - 1)), F.lit(0)), F.lit(steps))
    # Rounding of p * (steps - 1) can be off by one; compare with the thresholds.
    down = F.when((guess > 0) & (at(guess - 1) >= p), guess - 1).otherwise(guess)
    bins = F.when((down < steps) & (at(down) < p), down + 1).otherwise(down)
    known = df.where(F.col(label).isNotNull() & p.isNotNull())
    hist = known.groupBy(*keys, bins.cast("int").alias("bin")).agg(
        _sum_if(F.col(label) == 1).alias("pos"), _sum_if(F.col(label) != 1).alias("neg")
    )
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    all_bins = hist.select(*keys).distinct() if keys else hist.agg(F.lit(1).alias("_g"))
    all_bins = all_bins.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    full = all_bins.join(hist, [*keys, "bin"], "left").na.fill(0, ["pos", "neg"])
    above = group.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    out = full.withColumns(
        {
            "TP": F.coalesce(F.sum("pos").over(above), F.lit(0)), "FP": F.coalesce(F.sum("neg").over(above), F.lit(0)),
            "_p": F.sum("pos").over(group), "_q": F.sum("neg").over(group),
        }
    ).where(F.col("bin") < steps)
    tp, fp = F.col("TP"), F.col("FP")
    tn, fn = F.col("_q") - fp, F.col("_p") - tp
    return out.select(
        *keys, at(F.col("bin")).alias("threshold"),
        ratio(tp + fp, F.col("_p") + F.col("_q")).alias("fraction_days"),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(fp, fp + tn).alias("fpr"), ratio(fn, fn + tp).alias("fnr"),
        "TP", "FP", tn.alias("TN"), fn.alias("FN"),
    )


def class_shares(df: DataFrame, label: str, keys: list[str] = ()) -> DataFrame:
    """Row share of each class within its group."""
    counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(group))


def class_count(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count_distinct(label).alias("n_classes"))
