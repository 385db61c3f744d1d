"""Isotonic fit by ranges, clusters in shared passes, boosting of three classes, importance in one pass."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilspark.operators import learners as L
from perilspark.operators.clusters import kmeans_restarts
from perilspark.operators.isotonic import StepCalibration, fit_isotonic, pooled_blocks
from perilspark.operators.ranking import quantile_class, quantile_classes


def plain_fit(x, y):
    """The largest over starts below of the least mean over ends above."""
    order = np.argsort(x, kind="stable")
    levels, at = np.unique(np.asarray(x)[order], return_inverse=True)
    s, n = np.bincount(at, np.asarray(y, float)[order]), np.bincount(at)
    s, n = np.concatenate([[0], np.cumsum(s)]), np.concatenate([[0], np.cumsum(n)])
    k = len(levels)
    return {
        float(levels[i]): max(min((s[e + 1] - s[b]) / (n[e + 1] - n[b]) for e in range(i, k)) for b in range(i + 1)) for i in range(k)
    }


@pytest.mark.parametrize("kind", ["noise", "rising", "falling", "steps"])
@pytest.mark.parametrize("options", [{}, {"last": 0, "size": 8}])
def test_isotonic(spark, kind, options):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 120, 600) / 10
    y = {
        "noise": lambda: rng.random(600) < 0.5, "rising": lambda: rng.random(600) < x / 12,
        "falling": lambda: rng.random(600) < 1 - x / 12, "steps": lambda: np.floor(x) % 3 == 0,
    }[kind]().astype(int)
    rows = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)] + [(None, 1), (3.0, None)], "p double, y int")
    curve = fit_isotonic(rows, "p", "y", **options)
    want = plain_fit(x, y)
    got = {r["p"]: r["f"] for r in curve.transform(rows.where("p is not null").select("p").distinct(), "p", "f").collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_ranges_keep_what_rises(spark):
    """Nothing to pool: every point is a block, and rounds end."""
    points = spark.range(100).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("s"), F.lit(1.0).alias("n"))
    assert len(pooled_blocks(points, "x", "s", "n", last=0, size=8)) == 100


def test_curve_between_and_outside(spark):
    curve = StepCalibration.of_blocks([(0.1, 0.2, 1.0, 4.0), (0.4, 0.4, 3.0, 4.0)])
    df = spark.createDataFrame([(v,) for v in (0.0, 0.1, 0.15, 0.2, 0.3, 0.4, 0.9, None)], "p double")
    got = {r["p"]: r["f"] for r in curve.transform(df, "p", "f").where("f is null or f > 0").collect()}
    assert got == {0.0: 0.25, 0.1: 0.25, 0.15: 0.25, 0.2: 0.25, 0.3: pytest.approx(0.5), 0.4: 0.75, 0.9: 0.75, None: None}


def test_all_restarts_at_once(spark):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0], [40, 0], [0, 40]])
    rows = [(str(i), [float(v) for v in centres[i % 3] + rng.normal(size=2)]) for i in range(90)]
    points = spark.createDataFrame(rows, "k string, v array<double>")
    found, cost = kmeans_restarts(points, "k", "v", 3, 6)
    assert sorted([round(c / 40) * 40 for c in f] for f in found) == [[0, 0], [0, 40], [40, 0]]
    per = np.array([r[1] for r in rows])
    want = sum(((per[i::3] - per[i::3].mean(0)) ** 2).sum() for i in range(3))
    assert cost == pytest.approx(want)
    # The same again, and with fewer points than centres.
    assert kmeans_restarts(points, "k", "v", 3, 6)[0] == found
    few, none = kmeans_restarts(points.limit(1), "k", "v", 3, 2)
    assert none == 0 and few[0] == few[1] == few[2]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    data = []
    for i in range(900):
        a, b = rng.normal(), rng.normal()
        cls = 0 if a < -0.4 else 1 if a < 0.5 else 2
        data.append((i, float(a), float(b), "uv"[i % 2], cls, 3 * a + 0.1 * rng.normal()))
    return spark.createDataFrame(data, "id int, a double, b double, c string, cls int, t double")


@pytest.mark.parametrize("algorithm", ["hgbc", "xgbc", "lgbc"])
def test_boosting_of_three_classes(spark, rows, tmp_path, algorithm):
    model = L.fit_learner(rows, "cls", ["a", "b"], ["c"], algorithm, {"n_estimators": 5, "max_depth": 2}, n_classes=3)
    scored = model.with_label(model.score(rows)).collect()
    assert all(abs(sum(r[f"prob_class_{i}"] for i in range(3)) - 1) < 1e-12 for r in scored)
    assert np.mean([r["predicted"] == r["cls"] for r in scored]) > 0.95
    gains = {r["feature"]: r["importance"] for r in L.feature_importance(model).collect()}
    assert gains["a"] > 0.9 and sum(gains.values()) == pytest.approx(1)
    model.save(str(tmp_path / "m"))
    again = L.HazardModel.load(spark, str(tmp_path / "m")).score(rows).orderBy("id").first()
    assert again["prob_class_2"] == pytest.approx(model.score(rows).orderBy("id").first()["prob_class_2"])
    # A level and a number never seen, and missing values, have shares too.
    odd = spark.createDataFrame([(1, 99.0, None, "w"), (2, None, 0.0, None)], "id int, a double, b double, c string")
    assert all(sum(r[f"prob_class_{i}"] for i in range(3)) == pytest.approx(1) for r in model.score(odd).collect())


def test_importance_by_algorithm(rows):
    ids = ["id"]
    hist = L.fit_learner(rows, "cls", ["a", "b"], ["c"], "hgbc", {"n_estimators": 3, "max_depth": 2}, n_classes=3)
    lost = {r["feature"]: r["importance"] for r in L.importance(hist, rows, "cls", ids).collect()}
    assert lost["a"] > 0.4 and abs(lost["b"]) < 0.05 and set(lost) == {"a", "b", "c"}
    ranked = {r["feature"]: r["importance"] for r in L.importance(hist, rows, "cls", ids, metric="auc", repeats=2).collect()}
    assert ranked["a"] > 0.3
    number = L.fit_learner(rows, "t", ["a", "b"], [], "hgbr", {"n_estimators": 3, "max_depth": 3})
    lost = {r["feature"]: r["importance"] for r in L.importance(number, rows, "t", ids).collect()}
    assert lost["a"] > 1 and abs(lost["b"]) < 0.1
    gain = L.fit_learner(rows, "t", ["a", "b"], [], "lgbr", {"n_estimators": 2})
    assert {r["feature"] for r in L.importance(gain, rows, "t", ids).collect()} == {"a", "b"}


def test_permutation_equals_a_plain_loop(rows):
    """Every feature moved by the drawn step along the hash order, scored on its own."""
    import hashlib

    model = L.fit_learner(rows, "cls", ["a", "b"], [], "hgbc", {"n_estimators": 2, "max_depth": 2}, n_classes=3)
    data = sorted(rows.collect(), key=lambda r: hashlib.md5(str(r["id"]).encode()).hexdigest())
    n, spark = len(data), rows.sparkSession

    def accuracy(a, b):
        df = spark.createDataFrame([(float(x), float(y), r["cls"]) for x, y, r in zip(a, b, data)], "a double, b double, cls int")
        return model.with_label(model.score(df)).agg(F.avg((F.col("predicted") == F.col("cls")).cast("double"))).first()[0]

    a, b = [r["a"] for r in data], [r["b"] for r in data]
    base, losses = accuracy(a, b), []
    for repeat in range(2):
        step = 1 + (repeat + 24) * 2654435761 % (n - 1)
        losses.append(base - accuracy([a[(i - step) % n] for i in range(n)], b))
    got = {r["feature"]: r["importance"] for r in L.permutation_importance(model, rows, "cls", ["id"], repeats=2).collect()}
    assert got["a"] == pytest.approx(sum(losses) / 2)


def test_parameters_are_mapped_or_named():
    with pytest.warns(UserWarning, match="base_score, other"):
        assert L.boosting_parameters({"base_score": 0.04, "other": 1, "max_leaves": 6, "max_depth": 9}) == {"maxDepth": 3}
    assert L.boosting_parameters({"num_leaves": 30, "scale_pos_weight": 3, "max_depth": 2}) == {"maxDepth": 2}


def test_quantile_classes_equal_one_by_one(spark, rows):
    scored = rows.withColumns({"p": F.round(F.col("a"), 1), "q": F.round(F.col("b"), 0)})
    both = quantile_classes(scored, {"p": "cp", "q": "cq"}, ["c"], 7, ["t", "id"])
    assert set(both.columns) == {*scored.columns, "cp", "cq"} and both.count() == 900
    one = {r["id"]: r["k"] for r in quantile_class(scored, "p", ["c"], 7, ["t", "id"], "k").collect()}
    two = {r["id"]: r["k"] for r in quantile_class(scored, "q", ["c"], 7, ["t", "id"], "k").collect()}
    assert all((one[r["id"]], two[r["id"]]) == (r["cp"], r["cq"]) for r in both.collect())
