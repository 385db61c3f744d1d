from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute
from perilspark.operators import metrics as M
from perilspark.operators.ordered import dense_rank_levels, ordered_row_number, running_sums, with_level_bucket, with_row_bucket
from perilspark.operators.ranking import best_trials, quantile_class, rank_trials


@pytest.fixture(scope="module")
def scored():
    """A third of the rows in one group, half of the scores tied at zero."""
    rng = np.random.default_rng(11)
    n = 3000
    p = np.where(rng.random(n) < 0.5, 0.0, rng.random(n).round(3))
    g = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 40, n).astype(str))
    y = (rng.random(n) < 0.2 + 0.5 * p).astype(int)
    return pd.DataFrame({"id": range(n), "g": g, "y": y, "p": p})


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, scored, descending):
    levels = scored.groupby(["g", "p"], as_index=False).agg(n=("id", "size"))
    want = levels.sort_values("p", ascending=not descending)
    want = want.assign(cum=want.groupby("g")["n"].cumsum(), total=want.groupby("g")["n"].transform("sum"))
    got = running_sums(spark.createDataFrame(levels), ["g"], "p", ["n"], descending, buckets=7).toPandas()
    both = want.merge(got, on=["g", "p"])
    assert len(both) == len(levels) and (both["cum"] == both["cum_n"]).all() and (both["total"] == both["total_n"]).all()


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_row_numbers(spark, scored, keys):
    got = ordered_row_number(spark.createDataFrame(scored), keys, [-F.col("p"), F.col("id")], "r", buckets=9).toPandas()
    want = scored.sort_values(["p", "id"], ascending=[False, True])
    want["want"] = want.groupby("g").cumcount() + 1 if keys else range(1, len(want) + 1)
    both = want.merge(got, on="id")
    assert (both["want"] == both["r"]).all()


def test_no_task_holds_a_hot_group(spark, scored):
    """One group with a third of the rows, half of the scores tied at zero."""
    df = spark.createDataFrame(scored)
    levels = df.groupBy("g", "p").agg(F.count(F.lit(1)).alias("n"))
    bucketed = with_level_bucket(levels, F.col("p"), 10)
    largest = bucketed.groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * levels.count() / 10
    # Rows that tie in the score are cut by the columns that decide ties.
    bucketed = with_row_bucket(df, [-F.col("p"), F.col("id")], 10)
    largest = bucketed.groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * len(scored) / 10


@pytest.mark.parametrize("buckets", [2, 3, 8, 9, 50])
def test_buckets_are_monotone(spark, scored, buckets):
    df = spark.createDataFrame(scored)
    levels = df.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    rows = with_level_bucket(levels, F.col("p"), buckets).orderBy("p").collect()
    assert [r["_bucket"] for r in rows] == sorted(r["_bucket"] for r in rows) and len({r["_bucket"] for r in rows}) == buckets
    rows = with_row_bucket(df, [-F.col("p"), F.col("id")], buckets).orderBy(F.desc("p"), "id").collect()
    assert [r["_bucket"] for r in rows] == sorted(r["_bucket"] for r in rows) and len({r["_bucket"] for r in rows}) > buckets / 2


def test_one_exchange_serves_sums_and_totals(spark, scored):
    """Levels are computed once, and their exchange by (key, bucket) is read twice."""
    df = spark.createDataFrame(scored)
    curve = M.score_curve(df, "y", "p", ["g"])
    curve.collect()
    final = curve._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_missing_and_empty(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 0.5, 2), ("b", 0.5, 3)], "g string, p double, id int")
    got = {r["id"]: (r["r"], r["r_of"]) for r in ordered_row_number(df, ["g"], [F.col("p").isNull(), -F.col("p"), F.col("id")], "r").collect()}
    assert got == {1: (2, 2), 2: (1, 2), 3: (1, 1)}
    assert ordered_row_number(df.where("false"), [], [F.col("id")], "r").count() == 0
    assert running_sums(df.where("false").select("p", "id"), [], "p", ["id"]).count() == 0


def test_dense_ranks_put_missing_last(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (None,)], "v double")
    assert {r["v"]: r["k"] for r in dense_rank_levels(df, "v", "k", True).collect()} == {3.0: 1, 1.0: 2, None: 3}


def test_curve_metrics_equal_brute_force(spark, scored):
    got = M.binary_metrics(spark.createDataFrame(scored), "y", "p", ["g"]).toPandas().set_index("g")
    for g, rows in scored.groupby("g"):
        y, p = rows["y"].to_numpy(), rows["p"].to_numpy()
        if 0 < y.sum() < len(y):
            assert got.loc[g, "AUC"] == pytest.approx(brute.auc(y, p))
            assert got.loc[g, "KS"] == pytest.approx(brute.ks(y, p))
            assert got.loc[g, "GINI"] == pytest.approx(2 * brute.auc(y, p) - 1)
        assert got.loc[g, "PR"] == pytest.approx(brute.precision_at_recall(y, p, 0.25) if y.sum() else 0.0)


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.4), (1, 0.6)], "y int, p double")
    row = M.binary_metrics(df, "y", "p").first()
    assert row["AUC"] is None and row["KS"] is None and row["REC"] == 0.5


def test_sweep_is_strict(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 1.0), (0, 0.0)], "y int, p double")
    rows = {round(r["threshold"], 2): r for r in M.threshold_sweep(df, "y", "p", steps=11).collect()}
    assert len(rows) == 11
    assert (rows[0.5]["TP"], rows[0.5]["FP"]) == (1, 0) and (rows[0.4]["TP"], rows[0.4]["FP"]) == (2, 1)
    assert all(r["TP"] + r["FP"] + r["TN"] + r["FN"] == 4 for r in rows.values())
    assert rows[1.0]["TP"] == 0 and rows[0.0]["TN"] == 1


def test_sweep_equals_counting(spark, scored):
    got = M.threshold_sweep(spark.createDataFrame(scored), "y", "p", steps=101).orderBy("threshold").toPandas()
    for i, t in enumerate(np.linspace(0, 1, 101)):
        hit = scored["p"] > t
        assert got["TP"][i] == (hit & (scored["y"] == 1)).sum() and got["FP"][i] == (hit & (scored["y"] == 0)).sum()


@pytest.mark.parametrize("values,median", [([3.0, 1.0, 2.0], 2.0), ([4.0, 1.0, 2.0, 3.0], 2.5), ([1.0, 1.0, 1.0, 9.0], 1.0), ([1.0, 9.0], 5.0)])
def test_exact_median(spark, values, median):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert M.exact_median(df, "v").first()["median"] == median


@pytest.mark.parametrize("n,q", [(37, 20), (100, 20), (5, 3), (21, 20), (20, 20)])
def test_quantile_class_equals_interpolated_cuts(spark, n, q):
    rng = np.random.default_rng(n)
    scores = rng.integers(0, 6, n) / 6
    rows = [("s", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(scores)]
    df = spark.createDataFrame(rows, "station string, time date, p double")
    got = quantile_class(df, "p", ["station"], q, ["time"], "c").orderBy("time").collect()
    assert [r["c"] for r in got] == brute.quantile_class(list(scores), q)


def test_quantile_class_of_a_single_row(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), 0.5)], "station string, time date, p double")
    assert quantile_class(df, "p", ["station"], 20, ["time"], "c").first()["c"] == 1


def test_trial_ranking(spark):
    rows = [(0, 0.1, 0.8), (1, 0.0, 0.7), (2, None, 0.9), (3, 0.1, None)]
    df = spark.createDataFrame(rows, "trial_number int, gap_train_test double, mean_test_score double")
    ranked = rank_trials(df)
    assert {r["trial_number"]: r["mean_rank"] for r in ranked.collect()} == {0: 2.0, 1: 2.0, 2: 2.0, 3: 3.0}
    assert best_trials(ranked).first()["trial_number"] == 1  # lowest score wins a tied rank


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        M.metric_by_group(spark.range(1), "id", "id", [], "F2")
