from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilspark.functions.flags import AlertThresholds
from perilspark.operators import learners as L
from perilspark.operators.metrics import auc
from perilspark.operators.split import assign_subsets, backtest_flag, holdout_groups, shuffle_folds
from perilspark.plans.modelling import ModelSpec, final_model, predict, prepare, resolve_scorer, tune

SPEC = ModelSpec(label="y", numeric=["a", "b"], categorical=["c"], months_backtest=3, group_fraction=0.25, stratify="zone", quantiles=4)
PARAMS = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "scale_pos_weight": 2}


@pytest.fixture(scope="module")
def master(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(1200):
        a, b, c = rng.normal(), rng.normal(), "xyz"[rng.integers(3)]
        y = int(a + (c == "x") + 0.2 * rng.normal() > 0.8)
        day = dt.date(2022, 1, 1) + dt.timedelta(days=int(rng.integers(700)))
        station = int(rng.integers(20))
        rows.append((i, station, "zone%d" % (station % 2), day, f"{day:%Y%m}", None if i % 50 == 0 else float(a), float(b), c, y))
    return spark.createDataFrame(rows, "id int, station_id int, zone string, time date, yearmon string, a double, b double, c string, y int")


@pytest.fixture(scope="module")
def prepared(master):
    return prepare(master, SPEC)


def test_subsets_cover_and_do_not_overlap(prepared, master):
    rows = prepared.collect()
    assert len(rows) == master.count() and {r["subset"] for r in rows} == {"train", "backtest", "out_of_sample"}
    out = {r["station_id"] for r in rows if r["subset"] == "out_of_sample"}
    assert len(out) == 5 and not out & {r["station_id"] for r in rows if r["subset"] != "out_of_sample"}
    train, late = ({r["yearmon"] for r in rows if r["subset"] == s} for s in ("train", "backtest"))
    assert len(late) == 3 and max(train) < min(late)


def test_required_columns_drop_rows(master):
    assert assign_subsets(master, 2, required=["a"]).count() == 1200 - 24


def test_split_arguments(master):
    for bad in ({"n_slices": 999}, {"frac_slices": 1.5}, {"frac_slices": 0}):
        with pytest.raises(ValueError):
            backtest_flag(master, "yearmon", **bad)


def test_holdout_is_repeatable_and_stratified(master):
    first, second = ({r[0] for r in holdout_groups(master, "station_id", 0.25, "zone").collect()} for _ in range(2))
    assert first == second and len([s for s in first if s % 2 == 0]) == 3
    assert first != {r[0] for r in holdout_groups(master, "station_id", 0.25, "zone", seed=1).collect()}


def test_folds(master):
    rows = shuffle_folds(master, "yearmon", 4, 0.25).collect()
    months = master.select("yearmon").distinct().count()
    assert {f: sum(r["fold"] == f for r in rows) for f in range(4)} == dict.fromkeys(range(4), -(-months // 4))


def test_final_model(spark, prepared, master, tmp_path):
    result = final_model(prepared, SPEC, PARAMS)
    scored = result.predictions
    assert scored.count() == prepared.count()
    assert auc(scored, "y", "prob_class_1", ["subset"]).agg(F.min("auc")).first()[0] > 0.85
    rows = scored.collect()
    assert all(abs(r["prob_class_0"] + r["prob_class_1"] - 1) < 1e-9 for r in rows)
    assert {r["quantile_class_1"] for r in rows} == {1, 2, 3, 4}
    raw = L.HazardModel(result.model.algorithm, result.model.features, result.model.stages).score(prepared)
    pairs = sorted((r["p"], r["q"]) for r in raw.select("id", F.col("prob_class_1").alias("p")).join(
        scored.select("id", F.col("prob_class_1").alias("q")), "id").collect())
    assert all(x[1] <= y[1] + 1e-9 for x, y in zip(pairs, pairs[1:]))  # calibration keeps the order
    report = {r["metric"]: r for r in result.metrics.collect()}
    assert set(report) == {"AUC", "GINI", "KS", "PREC", "RECALL", "F1", "JACCARD"}
    assert report["GINI"]["train"] == pytest.approx(2 * report["AUC"]["train"] - 100)
    assert result.specification.first()["num_variables"] == 3
    gains = {r["feature"]: r["importance"] for r in result.importance.collect()}
    assert sum(gains.values()) == pytest.approx(1) and max(gains, key=gains.get) == "a"

    result.model.save(str(tmp_path / "model"))
    again = L.HazardModel.load(spark, str(tmp_path / "model")).score(prepared)
    drift = again.join(scored.select("id", F.col("prob_class_1").alias("q")), "id").agg(F.max(F.abs(F.col("prob_class_1") - F.col("q"))))
    assert drift.first()[0] < 1e-12

    fresh = master.withColumn("c", F.lit("never seen")).drop("y")
    alerts = predict(fresh, result.model, ["c"], AlertThresholds(0.4, 0.1), ["id", "time", "absent"])
    assert alerts.columns == ["id", "time", "pred_target", "alert_level"] and alerts.count() == 1200

    lost = {r["feature"]: r["importance"] for r in L.permutation_importance(result.model, prepared, "y", ["id"], 1).collect()}
    assert max(lost, key=lost.get) == "a" and lost["a"] > 0.1 > abs(lost["b"])


def test_tuning(prepared):
    space = {"n_estimators": {"type": "int", "low": 1, "high": 3}, "max_depth": {"type": "categorical", "choices": [2, 3]}}
    result = tune(prepared, SPEC, space, n_trials=2, folds=2)
    trials = result.trials.collect()
    assert [t["state"] for t in trials] == ["COMPLETE"] * 2
    assert all(t["gap_train_test"] == pytest.approx(t["mean_train_score"] - t["mean_test_score"]) for t in trials)
    assert all(0.6 < t["mean_test_score"] <= 1 for t in trials)


def test_regression_run(prepared):
    spec = ModelSpec(label="b", numeric=["a"], algorithm="xgbr", group=None, months_backtest=3)
    result = final_model(prepared.where("subset != 'x'"), spec, {"n_estimators": 2, "max_depth": 2})
    assert {r["metric"] for r in result.metrics.collect()} == {"R2", "RMSE", "MAE", "MEAE", "MAXE"}


def test_three_classes(prepared):
    three = prepared.withColumn("y", F.col("station_id") % 3)
    model = L.fit_learner(three, "y", ["a", "b"], ["c"], "xgbc", {"n_estimators": 3}, n_classes=3)
    row = model.with_label(model.score(three)).first()
    assert sum(row[f"prob_class_{i}"] for i in range(3)) == pytest.approx(1) and row["predicted"] in (0, 1, 2)
    with pytest.raises(ValueError):
        L.calibrate(model, three, "y")


def test_names_and_spaces():
    with pytest.raises(ValueError):
        L.make_learner("catboost")
    with pytest.raises(ValueError):
        resolve_scorer("accuracy")
    for spec in ([1, 2], {"low": 1}, {"type": "word"}):
        with pytest.raises(KeyError):
            L.parameter_space({"x": spec})
    space = L.parameter_space({
        "i": {"type": "int", "low": 10, "high": 75, "step": 5}, "f": {"type": "float", "low": 0.01, "high": 0.25, "step": 0.01},
        "l": {"type": "float", "low": 1e-4, "high": 1.0, "log": True}, "c": {"type": "categorical", "choices": [0.04, 0.05]}})
    trials = L.draw_trials(space, 200, seed=1)
    assert trials == L.draw_trials(space, 200, seed=1)
    assert {t["i"] % 5 for t in trials} == {0} and {t["i"] for t in trials} >= {10, 75}
    assert all(0.01 <= t["f"] <= 0.25 and t["c"] in (0.04, 0.05) and 1e-4 <= t["l"] <= 1 for t in trials)
    assert L.Choice("int", 1, 3).draw(random.Random(0)) in (1, 2, 3)


def test_balanced_weights(prepared):
    weighted = L.class_weights(prepared, "y", "hgbc")
    sums = [r[0] for r in weighted.groupBy("y").agg(F.sum("_weight")).select("sum(_weight)").collect()]
    assert sums[0] == pytest.approx(sums[1])


def test_clusters(spark):
    rng = np.random.default_rng(1)
    rows = []
    for s in range(30):
        for w in range(1, 54):
            if not (s == 3 and w == 7):
                rows.append((s, float(s % 3), w, 50.0 * (s % 3) + rng.normal()))
    df = spark.createDataFrame(rows, "station_id int, lat double, week int, v double")
    out = L.climate_clusters(df, "v", ["station_id"], ["lat"], restarts=3).collect()
    groups = {}
    for r in out:
        groups.setdefault(r["cluster"], set()).add(r["station_id"] % 3)
    assert len(out) == 30 and len(groups) == 3 and all(len(g) == 1 for g in groups.values())


def test_more_levels_than_the_least_bins(spark):
    rows = spark.range(600).selectExpr("cast(id % 100 as string) as kind", "cast(id as double) as x", "cast(id % 2 as int) as y")
    model = L.fit_learner(rows, "y", ["x"], ["kind"], "xgbc", {"n_estimators": 1, "max_depth": 2})
    assert model.score(rows).where("prob_class_1 is not null").count() == 600
