"""Rows alike in all features, taken as one by trees and scorers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from perilspark.operators import learners
from perilspark.operators.learners import alike_rows, each_row
from perilspark.plans import modelling
from perilspark.plans.modelling import ModelSpec, cross_validate, default_scorer, prepare_folds


@pytest.fixture(scope="module")
def train(spark):
    k = F.col("id")
    rows = spark.range(6000).select(
        (F.pmod(F.xxhash64(k), F.lit(7)) + k % 5 > 6).cast("int").alias("y"), (k % 3).cast("int").alias("three"),
        F.when(k % 11 > 0, k % 5).cast("double").alias("a"), F.pmod(F.xxhash64(k), F.lit(7)).cast("double").alias("b"),
        (k % 2).cast("string").alias("c"), (k % 4).cast("string").alias("yearmon"),
    )
    return rows.unionByName(rows.limit(500))


def test_each_row_is_the_inverse(spark, monkeypatch):
    monkeypatch.setattr(learners, "COPIES", 3)
    rows = spark.createDataFrame([(1, None)] * 10 + [(2, "x")] * 3 + [(None, "x")], "a int, b string")
    assert alike_rows(rows).count() == 3
    assert sorted(map(str, each_row(alike_rows(rows)).collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize("algorithm, label, classes", [("xgbc", "y", 2), ("hgbc", "y", 2), ("xgbc", "three", 3)])
def test_fold_tables_hold_rows_alike_once(train, monkeypatch, algorithm, label, classes):
    """Few rows a fold, the same scores as from each row."""
    spec = ModelSpec(label=label, numeric=["a", "b"], categorical=["c"], algorithm=algorithm, n_classes=classes)
    params = {"n_estimators": 2, "max_depth": 2}
    folds = prepare_folds(train, spec, {0: ["0"]})
    assert folds[0].rows.count() < 700
    got = cross_validate(folds, spec, params, default_scorer)
    monkeypatch.setattr(modelling, "alike_rows", lambda df: df)
    plain = prepare_folds(train, spec, {0: ["0"]})
    assert plain[0].rows.count() == train.count()
    assert got == pytest.approx(cross_validate(plain, spec, params, default_scorer), abs=1e-9)


def test_other_scorers_and_sampled_rows_get_each_row(train):
    spec = ModelSpec(label="y", numeric=["a", "b"], categorical=["c"])
    folds = prepare_folds(train, spec, {0: ["0"]})
    seen = cross_validate(folds, spec, {"n_estimators": 1, "min_child_samples": 50}, lambda model, df, spec: model.score(df).count())
    assert sum(seen) == train.count()
