"""Spark ML building blocks: clusters, learners, calibration, importance."""

from __future__ import annotations

import math
import random
import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import PCA, Imputer, QuantileDiscretizer, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..session import materialise
from .clusters import assigned, kmeans_restarts
from .isotonic import StepCalibration, fit_isotonic
from .metrics import auc, one_vs_rest
from .ordered import ordered_row_number


def weekly_profile(records: DataFrame, value: str, station: list[str], static: list[str]) -> DataFrame:
    """Mean value per ISO week 1..52 as columns, with station attributes.

    Week 53 is left out. The weeks are listed, so the pivot is one pass.
    """
    weeks = records.groupBy(*station).pivot("week", list(range(1, 53))).agg(F.avg(value))
    named = weeks.withColumnsRenamed({str(w): f"{value}_{w}" for w in range(1, 53)})
    return records.select(*station, *static).distinct().join(named, station)


def cluster_stations(
    profile: DataFrame, station: list[str], components: int = 4, k: int = 3, restarts: int = 18, seed: int = 42
) -> DataFrame:
    """Standardise, reduce and cluster stations; adds comp_i and ``cluster``.

    The best of ``restarts`` k-means runs counts; all runs go through the same
    passes. Cluster numbers carry no order. A missing value takes the mean over stations.
    """
    inputs = [c for c in profile.columns if c not in station]
    filled = [f"_f_{c}" for c in inputs]
    imputer = Imputer(inputCols=inputs, outputCols=filled, strategy="mean")
    assembler = VectorAssembler(inputCols=filled, outputCol="_raw", handleInvalid="error")
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="_raw", outputCol="_scaled")
    reduce = PCA(k=min(components, len(inputs)), inputCol="_scaled", outputCol="_pca")
    ready = Pipeline(stages=[imputer, assembler, scaler, reduce]).fit(profile).transform(profile)
    # One row per station, read once per round.
    ready = materialise(ready.select(*station, vector_to_array("_pca").alias("_v"), hash_key(*station).alias("_key")), "station-components")
    centres, _ = kmeans_restarts(ready, "_key", "_v", k, restarts, seed)
    named = {f"comp_{i}": F.get("_v", i) for i in range(min(components, len(inputs)))}
    return assigned(ready, centres, "_v").withColumns(named).drop("_v", "_key")


def climate_clusters(records: DataFrame, value: str, station: list[str], static: list[str], **options) -> DataFrame:
    """Stations grouped by their weekly climate, position and altitude."""
    dated = records if "week" in records.columns else records.withColumn("week", F.weekofyear("time"))
    return cluster_stations(weekly_profile(dated, value, station, static), station, **options)


# Learner names of a run configuration.
CLASSIFIERS = ("hgbc", "xgbc", "lgbc")
REGRESSORS = ("hgbr", "xgbr", "lgbr")

#: Split candidates of a feature; more where a category has more levels.
MIN_BINS = 64

#: How the report names what stands behind every configured learner.
LEARNER = "Spark ML gradient-boosted trees"

# Names of boosting parameters in a configuration and in Spark ML.
_BOOSTING = {
    "n_estimators": "maxIter", "max_iter": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize",
    "subsample": "subsamplingRate", "min_child_samples": "minInstancesPerNode",
    "colsample_bytree": "featureSubsetStrategy", "feature_fraction": "featureSubsetStrategy", "max_features": "featureSubsetStrategy",
}
# Leaf counts: a tree of depth d has 2^d leaves at most.
_LEAVES = ("max_leaves", "num_leaves", "max_leaf_nodes")
# Used elsewhere in a fit, or about the run alone.
_OTHER = ("scale_pos_weight", "random_state", "n_jobs", "verbose")


def is_classifier(algorithm: str) -> bool:
    if algorithm not in CLASSIFIERS + REGRESSORS:
        raise ValueError(f"no learner is registered for {algorithm!r}")
    return algorithm in CLASSIFIERS


def make_learner(algorithm: str, n_classes: int = 2, params: dict | None = None, seed: int = 24, bins: int = MIN_BINS):
    """Tree learner for a configured name with configured parameters.

    ``bins`` is at least the number of levels of the richest category.
    """
    common = {"featuresCol": "features", "labelCol": "_label", "seed": seed, "maxBins": bins, "weightCol": "_weight"}
    given = boosting_parameters(params)
    if is_classifier(algorithm):
        return GBTClassifier(**common, **given)
    return GBTRegressor(**common, **given)


def boosting_parameters(params: dict | None) -> dict:
    """Configured parameters by Spark ML's names.

    A leaf count bounds the depth. What has no counterpart is named in a warning.
    """
    given, unknown = {}, []
    for name, value in (params or {}).items():
        if name in _BOOSTING:
            spark_name = _BOOSTING[name]
            given[spark_name] = str(value) if spark_name == "featureSubsetStrategy" else value
        elif name not in _LEAVES + _OTHER:
            unknown.append(name)
    leaves = [int(v) for k, v in (params or {}).items() if k in _LEAVES and v and int(v) > 1]
    if leaves:
        given["maxDepth"] = min(given.get("maxDepth", 5), math.ceil(math.log2(min(leaves))))
    if unknown:
        warnings.warn(f"parameters without a counterpart are not used: {', '.join(sorted(unknown))}", stacklevel=3)
    return given


def class_weights(df: DataFrame, label: str, algorithm: str, params: dict | None = None, n_classes: int = 2) -> DataFrame:
    """Add ``_weight``: ``scale_pos_weight`` on positives of two classes, or balanced."""
    positive = (params or {}).get("scale_pos_weight")
    if positive is not None and n_classes == 2:
        return df.withColumn("_weight", F.when(F.col(label) == 1, float(positive)).otherwise(1.0))
    if algorithm == "hgbc":
        number = F.sum(ROWS) if ROWS in df.columns else F.count("*")
        counts = {r[0]: r[1] for r in df.groupBy(label).agg(number).collect()}  # one row per class
        total = sum(counts.values())
        weight = F.lit(1.0)
        for cls, n in counts.items():
            weight = F.when(F.col(label) == cls, total / (len(counts) * n)).otherwise(weight)
        return df.withColumn("_weight", weight)
    return df.withColumn("_weight", F.lit(1.0))


#: For how many rows one of ``alike_rows`` stands, and copies that one step of ``each_row`` makes.
ROWS, COPIES = "_rows", 1 << 16


def alike_rows(df: DataFrame) -> DataFrame:
    """Equal rows as one, with their number ``_rows``.

    Features are places among a few quantiles and category codes, so many rows are
    alike in all of them; where none are, the table stays as long as it was.
    """
    return df.groupBy(*df.columns).agg(F.count("*").alias(ROWS))


def each_row(df: DataFrame) -> DataFrame:
    """The rows that ``alike_rows`` made one of."""
    first = df.withColumn("_first", F.explode(F.sequence(F.lit(0), F.col(ROWS) - 1, F.lit(COPIES))))
    copies = F.array_repeat(F.lit(True), F.least(F.col(ROWS) - F.col("_first"), F.lit(COPIES)).cast("int"))
    return first.withColumn("_copy", F.explode(copies)).drop("_first", "_copy", ROWS)


def weighs_rows(algorithm: str, params: dict | None) -> bool:
    """Whether trees from weighted rows are those from each row: not if rows are sampled or counted in a node."""
    given = boosting_parameters(params)
    return is_classifier(algorithm) and float(given.get("subsamplingRate", 1)) == 1 and int(given.get("minInstancesPerNode", 1)) == 1


@dataclass
class HazardModel:
    """Fitted feature stages and trees, with an optional calibration.

    Beyond two classes ``boosters`` holds one tree ensemble per class, all on
    the features that ``stages`` give; otherwise the trees are the last stage.
    """

    algorithm: str
    features: list[str]
    stages: PipelineModel
    calibration: StepCalibration | None = None
    n_classes: int = 2
    boosters: list[PipelineModel] = field(default_factory=list)

    def raw_scores(self, df: DataFrame) -> DataFrame:
        """Uncalibrated ``prob_class_i`` columns, or ``pred_target``."""
        scored = self.stages.transform(df)
        if not is_classifier(self.algorithm):
            return scored.select(*df.columns, F.col("prediction").alias("pred_target"))
        if not self.boosters:
            p = vector_to_array("probability")
            return scored.select(*df.columns, *[F.get(p, i).alias(f"prob_class_{i}") for i in range(self.n_classes)])
        for booster in self.boosters:
            scored = booster.transform(scored)
        own = [F.get(vector_to_array(f"_probability_{i}"), 1) for i in range(self.n_classes)]
        scored = scored.select(*df.columns, F.array(*own).alias("_own"))
        total = F.aggregate("_own", F.lit(0.0), lambda a, b: a + b)
        share = [F.coalesce(F.try_divide(F.get("_own", i), total), F.lit(1.0 / self.n_classes)) for i in range(self.n_classes)]
        return scored.select(*df.columns, *[c.alias(f"prob_class_{i}") for i, c in enumerate(share)])

    def score(self, df: DataFrame) -> DataFrame:
        scored = self.raw_scores(df)
        if self.calibration is None:
            return scored
        fitted = self.calibration.transform(scored, "prob_class_1", "_fitted")
        return fitted.select(*df.columns, (1 - F.col("_fitted")).alias("prob_class_0"), F.col("_fitted").alias("prob_class_1"))

    def with_label(self, df: DataFrame) -> DataFrame:
        """Add ``predicted``: the class with the highest probability."""
        probs = F.array(*[f"prob_class_{i}" for i in range(self.n_classes)])
        return df.withColumn("predicted", (F.array_position(probs, F.array_max(probs)) - 1).cast("int"))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.stages.write().overwrite().save(f"{path}/stages")
        for i, booster in enumerate(self.boosters):
            booster.write().overwrite().save(f"{path}/class-{i}")
        if self.calibration is not None:
            self.calibration.save(spark, f"{path}/calibration")
        about = [(self.algorithm, self.features, self.n_classes, self.calibration is not None, len(self.boosters))]
        schema = "algorithm string, features array<string>, n_classes int, calibrated boolean, boosters int"
        spark.createDataFrame(about, schema).coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HazardModel:
        about = spark.read.json(f"{path}/about").first()
        calibration = StepCalibration.load(spark, f"{path}/calibration") if about["calibrated"] else None
        boosters = [PipelineModel.load(f"{path}/class-{i}") for i in range(about["boosters"])]
        return cls(about["algorithm"], list(about["features"]), PipelineModel.load(f"{path}/stages"), calibration, int(about["n_classes"]), boosters)


def _doubles(df: DataFrame, label: str, numeric: list[str]) -> DataFrame:
    return df.withColumns({"_label": F.col(label).cast("double"), **{c: F.col(c).cast("double") for c in numeric}})


def fit_features(train: DataFrame, numeric: list[str], categorical: list[str]) -> tuple[PipelineModel, int]:
    """Stages that index, impute and bin, fitted on training rows only, and the number of bins the trees need.

    Category levels come from training; a level first seen later gets its own
    code. Missing numbers take the training median. Numbers become the place
    among training quantiles, so that every tree of every trial, fold and class
    finds its splits among the same few codes.
    """
    coded = [f"{c}_code" for c in categorical]
    filled, binned, placed = ([f"{c}_{end}" for c in numeric] for end in ("filled", "bin", "place"))
    stages, bins = [], MIN_BINS
    if categorical:
        indexer = StringIndexer(inputCols=categorical, outputCols=coded, handleInvalid="keep").fit(train)
        bins = max(bins, 1 + max(len(levels) for levels in indexer.labelsArray))  # unseen levels share one more code
        stages.append(indexer)
    if numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=filled, strategy="median"))
        stages.append(QuantileDiscretizer(inputCols=filled, outputCols=binned, numBuckets=MIN_BINS, handleInvalid="keep"))
        # Buckets are marked as names; a sum is a plain number again, which trees split by its order.
        plain = ", ".join(f"`{b}` + 0D AS `{p}`" for b, p in zip(binned, placed))
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
    stages.append(VectorAssembler(inputCols=coded + placed, outputCol="features"))
    return Pipeline(stages=stages).fit(train), bins


def fit_trees(
    ready: DataFrame, algorithm: str, names: list[str], bins: int, params: dict | None = None, n_classes: int = 2, seed: int = 24
) -> HazardModel:
    """Trees on rows with ``features``, ``_label`` and ``_weight``; the model starts from ``features``.

    Beyond two classes, one ensemble per class against the rest, on the same
    table; shares of the classes' probabilities sum to 1.
    """
    if not is_classifier(algorithm) or n_classes == 2:
        return HazardModel(algorithm, names, PipelineModel([make_learner(algorithm, n_classes, params, seed, bins).fit(ready)]), None, n_classes)

    def fit(cls: int) -> PipelineModel:
        learner = make_learner(algorithm, n_classes, params, seed, bins)
        for column in ("prediction", "rawPrediction", "probability"):
            learner = learner.copy({getattr(learner, f"{column}Col"): f"_{column}_{cls}"})
        own = ready.withColumn("_label", (F.col("_label") == cls).cast("double"))
        return PipelineModel([learner.fit(own)])

    with ThreadPoolExecutor(min(n_classes, 4)) as pool:
        return HazardModel(algorithm, names, PipelineModel([]), None, n_classes, list(pool.map(fit, range(n_classes))))


def fit_learner(
    train: DataFrame, label: str, numeric: list[str], categorical: list[str], algorithm: str,
    params: dict | None = None, n_classes: int = 2, seed: int = 24,
) -> HazardModel:
    """Feature stages and trees, fitted on the training rows only."""
    ready = class_weights(train.where(F.col(label).isNotNull()), label, algorithm, params, n_classes)
    ready = _doubles(ready, label, numeric)
    stages, bins = fit_features(ready, numeric, categorical)
    # One table of features for all trees of all classes.
    table = stages.transform(ready).select("features", "_label", "_weight")
    if weighs_rows(algorithm, params):
        table = alike_rows(table).withColumn("_weight", F.col("_weight") * F.col(ROWS)).drop(ROWS)
    table = materialise(table, "features")
    model = fit_trees(table, algorithm, categorical + numeric, bins, params, n_classes, seed)
    model.stages = PipelineModel([*stages.stages, *model.stages.stages])
    return model


def calibrate(model: HazardModel, held_out: DataFrame, label: str) -> HazardModel:
    """Isotonic calibration of the class-1 probability on held-out rows."""
    if model.n_classes != 2 or not is_classifier(model.algorithm):
        raise ValueError("calibration needs a two-class learner")
    curve = fit_isotonic(model.raw_scores(held_out), "prob_class_1", label)
    return HazardModel(model.algorithm, model.features, model.stages, curve, 2, model.boosters)


def feature_importance(model: HazardModel) -> DataFrame:
    """Gain per feature as shares that sum to 1; the mean over classes where each has its trees."""
    trees = [b.stages[-1] for b in model.boosters] or [model.stages.stages[-1]]
    gains = sum(t.featureImportances.toArray() for t in trees)
    total = float(gains.sum()) or 1.0
    rows = [(name, float(g) / total) for name, g in zip(model.features, gains)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def _r2(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    e = F.col(label) - F.col("pred_target")
    return df.groupBy(*keys).agg((1 - F.try_divide(F.avg(e * e), F.var_pop(label))).alias("value"))


def model_quality(model: HazardModel, scored: DataFrame, label: str, metric: str, keys: list[str]) -> DataFrame:
    """(keys, value) of scored rows: ``accuracy``, ``auc`` or ``r2``."""
    if metric == "r2":
        return _r2(scored, label, keys)
    if metric == "accuracy":
        return model.with_label(scored).groupBy(*keys).agg(F.avg((F.col("predicted") == F.col(label)).cast("double")).alias("value"))
    if metric != "auc":
        raise ValueError(f"unknown metric {metric!r}; choose from accuracy, auc, r2")
    if model.n_classes > 2:
        found = one_vs_rest(scored, label, {i: f"prob_class_{i}" for i in range(model.n_classes)}, keys)
    else:
        found = auc(scored, label, "prob_class_1", keys)
    return found.select(*keys, F.col("auc").alias("value"))


def shuffle_step(n: Column, repeat: Column, seed: int) -> Column:
    """How far a repeat moves a column along the rows' hash order: 1 to n - 1."""
    return F.when(n > 1, 1 + (repeat + seed) * 2654435761 % (n - 1)).otherwise(0)


#: Neighbouring rows that a permutation moves together.
BLOCK_ROWS = 256


def _row_blocks(numbered: DataFrame, label: str, names: list[str]) -> DataFrame:
    """``_block``, the ``_rows`` of it in order (``_y`` and features) and ``_n``, the rows of all blocks."""
    row = F.struct("_i", F.col(label).alias("_y"), *names)
    packed = numbered.groupBy(F.floor((F.col("_i") - 1) / BLOCK_ROWS).alias("_block")).agg(
        F.sort_array(F.collect_list(row)).alias("_rows"), F.max("_i_of").alias("_n")
    )
    return packed.withColumn("_rows", F.transform("_rows", lambda x: x.dropFields("_i")))


def _moved_pairs(blocks: DataFrame, names: list[str], repeats: int, seed: int) -> DataFrame:
    """``_repeat``, ``_own`` row and ``_other`` row, which stands where the repeat's step puts it.

    A moved block is cut where a block begins, so each part lies in one.
    """
    size, n = F.lit(BLOCK_ROWS), F.col("_n")
    moving = blocks.select(
        "_n", F.size("_rows").alias("_size"), F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_repeat"),
        (F.col("_block") * size).alias("_start"), *[F.col("_rows").getField(f).alias(f"_f{i}") for i, f in enumerate(names)],
    ).withColumn("_start", (F.col("_start") + shuffle_step(n, F.col("_repeat"), seed)) % n)
    begins = F.filter(F.sequence(F.lit(0), F.col("_size") - 1), lambda j: (j == 0) | ((F.col("_start") + j) % n % size == 0))
    parts = moving.withColumn("_from", F.explode(begins)).withColumn("_to", (F.col("_start") + F.col("_from")) % n)
    length = F.least(F.col("_size") - F.col("_from"), size - F.col("_to") % size, n - F.col("_to")).cast("int")
    parts = parts.withColumn("_length", length).select(
        F.floor(F.col("_to") / size).alias("_block"), "_repeat", (F.col("_to") % size).cast("int").alias("_at"), "_length",
        *[F.slice(f"_f{i}", F.col("_from") + 1, F.col("_length")).alias(f"_f{i}") for i in range(len(names))],
    )
    other = [F.get(F.col(f"_f{i}"), F.col("_k")).alias(f) for i, f in enumerate(names)]
    met = parts.join(blocks.select("_block", "_rows"), "_block").withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_length") - 1)))
    return met.select("_repeat", F.get("_rows", F.col("_at") + F.col("_k")).alias("_own"), F.struct(*other).alias("_other"))


def permutation_importance(
    model: HazardModel, df: DataFrame, label: str, ids: list[str], repeats: int = 4, seed: int = 24, metric: str | None = None
) -> DataFrame:
    """Mean loss of quality when a feature is shuffled among the rows, for classifiers of any class count and regressors.

    Rows are numbered once in the order of a hash of their ``ids`` and packed in
    blocks of neighbours. In a repeat every row meets the row a drawn number of places on, by
    one join of blocks for all features; each pair gives a row per feature, with that feature taken from
    the other row. All are scored in one pass and one grouped metric tells
    features and repeats apart. The metric is accuracy, or R2 of a regressor,
    unless named (``auc``).
    """
    metric = metric or ("accuracy" if is_classifier(model.algorithm) else "r2")
    names, known = model.features, df.where(F.col(label).isNotNull())
    numbered = ordered_row_number(known.select(*dict.fromkeys([label, *ids, *names])), [], [hash_key(*ids), *map(F.col, ids)], "_i")
    blocks = materialise(_row_blocks(numbered, label, names), "permutation-blocks")
    variants = F.array(*[
        F.struct(F.lit(f).alias("feature"), *[F.col(f"_other.{g}" if g == f else f"_own.{g}").alias(g) for g in names]) for f in names
    ])
    moved = _moved_pairs(blocks, names, repeats, seed).select("_own._y", "_repeat", F.explode(variants).alias("_v"))
    moved = moved.select("_y", "_repeat", "_v.*")
    base = blocks.select(F.explode("_rows").alias("_own")).select("_own._y", F.lit(-1).alias("_repeat"), F.lit("").alias("feature"), *[f"_own.{f}" for f in names])
    scored = model.score(base.unionByName(moved))
    quality = materialise(model_quality(model, scored, "_y", metric, ["feature", "_repeat"]), "permutation-quality")
    unmoved = quality.where("_repeat < 0").select("value").scalar()
    lost = quality.where("_repeat >= 0").groupBy("feature").agg(F.avg("value").alias("moved"))
    return lost.select("feature", (unmoved - F.col("moved")).alias("importance")).orderBy(F.desc("importance"), "feature")


def importance(model: HazardModel, held_out: DataFrame, label: str, ids: list[str], **options) -> DataFrame:
    """By algorithm: permutation on held-out rows for the histogram learners, gain for the others."""
    if model.algorithm in ("hgbc", "hgbr"):
        return permutation_importance(model, held_out, label, ids, **options)
    return feature_importance(model)


@dataclass(frozen=True)
class Choice:
    """One dimension of a parameter space."""

    kind: str
    low: float = 0
    high: float = 1
    step: float | None = None
    log: bool = False
    choices: Sequence = field(default_factory=tuple)

    def __post_init__(self):
        if self.kind not in ("float", "int", "categorical"):
            raise KeyError(f"a parameter is 'float', 'int' or 'categorical', not {self.kind!r}")

    def draw(self, rng: random.Random):
        if self.kind == "categorical":
            return rng.choice(list(self.choices))
        if self.log:
            value = math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
            return int(round(value)) if self.kind == "int" else value
        step = self.step or (1 if self.kind == "int" else None)
        if step is None:
            return rng.uniform(self.low, self.high)
        value = self.low + rng.randint(0, int(round((self.high - self.low) / step, 9))) * step
        return int(value) if self.kind == "int" else round(value, 12)


def parameter_space(config: dict[str, dict]) -> dict[str, Choice]:
    """Space from configuration entries with ``type``, bounds or choices."""
    space = {}
    for name, spec in config.items():
        if not isinstance(spec, dict) or "type" not in spec:
            raise KeyError(f"parameter {name!r} has no type")
        options = {k: v for k, v in spec.items() if k != "type"}
        space[name] = Choice(spec["type"], **options)
    return space


def draw_trials(space: dict[str, Choice], n: int, seed: int = 42) -> list[dict]:
    rng = random.Random(seed)
    return [{name: choice.draw(rng) for name, choice in space.items()} for _ in range(n)]
