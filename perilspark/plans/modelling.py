"""Model runs: tuning, final model with calibration, daily scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import AlertThresholds
from ..operators.columns import as_categories
from ..operators.learners import (
    LEARNER,
    ROWS,
    HazardModel,
    alike_rows,
    calibrate,
    class_weights,
    draw_trials,
    each_row,
    feature_importance,
    fit_features,
    fit_learner,
    fit_trees,
    importance,
    is_classifier,
    parameter_space,
    weighs_rows,
)
from ..operators.metrics import auc, metric_rows, multiclass_report, one_vs_rest, regression_metrics, side_by_side
from ..operators.ranking import best_trials, quantile_classes, rank_trials
from ..operators.split import BACKTEST, OUT, TRAIN, assign_subsets, shuffle_folds
from ..session import materialise
from .alerts import with_alert_levels

SUBSETS = [TRAIN, BACKTEST, OUT]


@dataclass(frozen=True)
class ModelSpec:
    """What to learn from a master table."""

    label: str
    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    algorithm: str = "xgbc"
    n_classes: int = 2
    split: str = "yearmon"
    months_backtest: int = 48
    group: str | None = "station_id"
    stratify: str | None = None
    group_fraction: float = 0.25
    required: list[str] = field(default_factory=list)
    quantiles: int = 20


def prepare(master: DataFrame, spec: ModelSpec) -> DataFrame:
    """Master table with typed features and a ``subset`` column, written out.

    Every fit of a run reads this one table.
    """
    typed = as_categories(master, spec.categorical)
    split = assign_subsets(
        typed, spec.months_backtest, spec.split, spec.group, spec.group_fraction, spec.stratify, [spec.label, *spec.required]
    )
    return materialise(split, "prepared")


def _fit(df: DataFrame, spec: ModelSpec, params: dict | None) -> HazardModel:
    return fit_learner(df, spec.label, spec.numeric, spec.categorical, spec.algorithm, params, spec.n_classes)


def default_scorer(model: HazardModel, df: DataFrame, spec: ModelSpec) -> float:
    """AUC (one-vs-rest average beyond two classes), or R2 for regression.

    Of a classifier, a row of ``df`` may stand for as many as its ``_rows`` says.
    """
    scored, rows = model.score(df), ROWS if ROWS in df.columns else None
    if not is_classifier(spec.algorithm):
        return regression_metrics(scored, spec.label, "pred_target").first()["R2"]
    if spec.n_classes > 2:
        return one_vs_rest(scored, spec.label, {i: f"prob_class_{i}" for i in range(spec.n_classes)}, rows=rows).first()["auc"]
    return auc(scored, spec.label, "prob_class_1", rows=rows).first()["auc"]


def gini_scorer(model: HazardModel, df: DataFrame, spec: ModelSpec) -> float:
    return 2 * default_scorer(model, df, spec) - 1


SCORERS: dict[str, Callable] = {"roc_auc": default_scorer, "roc_auc_ovr": default_scorer, "r2": default_scorer, "gini": gini_scorer}


def resolve_scorer(scorer: str | Callable) -> Callable:
    """A registered name or any ``f(model, df, spec)``."""
    if callable(scorer):
        return scorer
    if scorer not in SCORERS:
        raise ValueError(f"unknown scorer {scorer!r}; choose from {sorted(SCORERS)} or pass a function")
    return SCORERS[scorer]


@dataclass
class Fold:
    """Feature stages of a fold, fitted on its training part, and all its rows with their features, written once.

    For a classifier, rows alike in label, part and features are one with a number ``_rows``.
    """

    number: int
    rows: DataFrame
    bins: int


def prepare_folds(train: DataFrame, spec: ModelSpec, test_months: dict[int, list[str]]) -> list[Fold]:
    """Index, impute and bin once per fold; every trial reads these tables."""
    typed = train.where(F.col(spec.label).isNotNull()).withColumns({c: F.col(c).cast("double") for c in spec.numeric})
    out = []
    for number, months in test_months.items():
        marked = typed.withColumn("_test", F.col(spec.split).isin(months))
        stages, bins = fit_features(marked.where(~F.col("_test")), spec.numeric, spec.categorical)
        kept = stages.transform(marked).select(spec.label, "_test", "features")
        out.append(Fold(number, materialise(alike_rows(kept) if is_classifier(spec.algorithm) else kept, "fold"), bins))
    return out


def cross_validate(folds: list[Fold], spec: ModelSpec, params: dict, scorer: Callable) -> tuple[float, float]:
    """Mean train and test score of one parameter set over the folds.

    Trees and the library's own scorers take rows that are alike as one; a scorer from elsewhere, and trees that sample or
    count rows, get each row.
    """
    pairs = []
    for fold in folds:
        alike = ROWS in fold.rows.columns
        rows = each_row(fold.rows) if alike and scorer not in SCORERS.values() else fold.rows
        training, testing = rows.where(~F.col("_test")), rows.where(F.col("_test"))
        ready = fold.rows.where(~F.col("_test"))
        if alike and not weighs_rows(spec.algorithm, params):
            ready = each_row(ready)
        ready = class_weights(ready, spec.label, spec.algorithm, params, spec.n_classes)
        if ROWS in ready.columns:
            ready = ready.withColumn("_weight", F.col("_weight") * F.col(ROWS))
        ready = ready.withColumn("_label", F.col(spec.label).cast("double"))
        model = fit_trees(ready, spec.algorithm, spec.categorical + spec.numeric, fold.bins, params, spec.n_classes)
        pairs.append((scorer(model, training, spec), scorer(model, testing, spec)))
    return tuple(sum(p[i] for p in pairs) / len(pairs) for i in (0, 1))


# Columns of the trial table. Choices are kept as text, since a choice may be one.
TRIAL_SCHEMA = (
    "date string, algorithm string, trial_number int, params map<string,string>, state string, "
    "mean_test_score double, mean_train_score double, gap_train_test double"
)


# Columns of a model's specification, and what stands behind the configured name.
SPECIFICATION_SCHEMA = (
    "date string, target string, params_split string, algorithm string, params_algorithm string, num_variables int, learner string"
)


@dataclass
class RunResult:
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame
    model: HazardModel
    trials: DataFrame | None = None
    specification: DataFrame | None = None
    best_params: dict | None = None


def _report(model: HazardModel, predictions: DataFrame, spec: ModelSpec) -> DataFrame:
    if is_classifier(spec.algorithm):
        probs = {i: f"prob_class_{i}" for i in range(spec.n_classes)}
        return multiclass_report(model.with_label(predictions), spec.label, "predicted", probs, "subset", SUBSETS)
    wide = regression_metrics(predictions, spec.label, "pred_target", ["subset"])
    return side_by_side(metric_rows(wide, ["subset"], ["R2", "RMSE", "MAE", "MEAE", "MAXE"]), "subset", SUBSETS)


def tune(
    prepared: DataFrame, spec: ModelSpec, space: dict[str, dict], n_trials: int, folds: int = 4,
    test_fraction: float = 0.25, scorer: str | Callable = "roc_auc", workers: int = 4, seed: int = 42,
) -> RunResult:
    """Random search scored on group folds, then a refit of the best set.

    Feature stages are fitted once per fold, not per trial. Fits run as Spark
    jobs; a few driver threads keep the cluster busy.
    """
    score = resolve_scorer(scorer)
    train = prepared.where(F.col("subset") == TRAIN)
    drawn = shuffle_folds(train, spec.split, folds, test_fraction, seed).collect()  # months x folds
    test_months = {f: [r[spec.split] for r in drawn if r["fold"] == f] for f in range(folds)}
    parts = prepare_folds(train, spec, test_months)
    trials = draw_trials(parameter_space(space), n_trials, seed)
    now = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")

    def run(number: int) -> tuple:
        fit_score, test_score = cross_validate(parts, spec, trials[number], score)
        params = {k: str(v) for k, v in trials[number].items()}
        return now, spec.algorithm, number, params, "COMPLETE", test_score, fit_score, fit_score - test_score

    with ThreadPoolExecutor(workers) as pool:
        rows = list(pool.map(run, range(n_trials)))
    ranked = rank_trials(train.sparkSession.createDataFrame(rows, TRIAL_SCHEMA))
    best = best_trials(ranked).first()["trial_number"]
    model = _fit(train, spec, trials[best])
    predictions = model.score(prepared)
    return RunResult(predictions, _report(model, predictions, spec), feature_importance(model), model, ranked, None, trials[best])


def final_model(prepared: DataFrame, spec: ModelSpec, params: dict, time: str = "time", ties: list[str] = ()) -> RunResult:
    """Fit on train, calibrate on backtest and out-of-sample, score all.

    Predictions get a quantile class per group and class probability. Where
    ``ties`` identify a row, learners that have no gain get their importance by
    permutation of the held-out rows.
    """
    model = _fit(prepared.where(F.col("subset") == TRAIN), spec, params)
    if is_classifier(spec.algorithm) and spec.n_classes == 2:
        model = calibrate(model, prepared.where(F.col("subset") != TRAIN), spec.label)
    predictions = model.score(prepared)
    if is_classifier(spec.algorithm) and spec.group:
        names = {f"prob_class_{i}": f"quantile_class_{i}" for i in range(spec.n_classes)}
        predictions = quantile_classes(predictions, names, [spec.group], spec.quantiles, [time, *ties])
    split = {"group_fraction": spec.group_fraction, "months_backtest": spec.months_backtest}
    now = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    about = [(now, spec.label, str(split), spec.algorithm, str(params), len(model.features), LEARNER)]
    specification = prepared.sparkSession.createDataFrame(about, SPECIFICATION_SCHEMA)
    if ties:
        held_out = prepared.where(F.col("subset") != TRAIN)
        gains = importance(model, held_out, spec.label, list(ties))
    else:
        gains = feature_importance(model)
    return RunResult(predictions, _report(model, predictions, spec), gains, model, None, specification, params)


def predict(master: DataFrame, model: HazardModel, categorical: list[str], thresholds: AlertThresholds, keep: list[str]) -> DataFrame:
    """Score new rows: descriptive columns, ``pred_target``, ``alert_level``."""
    scored = model.score(as_categories(master, categorical))
    kept = [c for c in keep if c in master.columns]
    return with_alert_levels(scored.select(*kept, F.col("prob_class_1").alias("pred_target")), thresholds)
