"""Delay models with MLlib: preparation, training, holdout metrics, importances, run log."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators import forest, linear, metrics
from windrow.operators.categories import dictionary, fit_bins
from windrow.operators.selection import split_hash, split_stratified
from windrow.schemas import CARRIER, SEED, TEST_SIZE
from windrow.session import written_once

DELAY_TARGET = "target_arrival_delay"
CLASS_TARGET = "target_is_delayed"
#: Trees of a forest that are grown together: a task holds the sums of their open nodes side by side.
TREES_AT_ONCE = 50


@dataclass(frozen=True)
class FeatureSet:
    categorical: Sequence[str]
    numeric: Sequence[str]

    def present(self, df: DataFrame) -> FeatureSet:
        have = set(df.columns)
        return FeatureSet(
            [c for c in self.categorical if c in have], [c for c in self.numeric if c in have]
        )

    @property
    def columns(self) -> list[str]:
        return [*self.categorical, *self.numeric]


FULL = FeatureSet(
    ["AIRLINE", "Origin", "Dest", "DAY_OF_WEEK", "DEP_HOUR"],
    ["Distance", "AirTime", "DepDelay", "Month", "DayofMonth"],
)
SIMPLE = FeatureSet(
    [CARRIER, "Origin", "Dest", "SEASON"],
    ["Month", "DayofMonth", "DayOfWeek", "DEP_HOUR", "Distance", "DepDelay"],
)


def prepare(df: DataFrame, features: FeatureSet = FULL) -> DataFrame:
    """Row key, the features that exist and both targets; rows with a null in them go."""
    used = [*features.present(df).columns, DELAY_TARGET, CLASS_TARGET]
    return df.select("flight_id", *used).dropna(subset=used)


def preprocessor(features: FeatureSet) -> Pipeline:
    """Two vectors: ``features`` has standardised numerics and one-hot categories, for linear
    models; ``indexed`` has plain numerics and category indexes, for trees, which split on sets
    of categories.

    A category not seen in training encodes as all zeros: the indexer keeps it as one extra
    last index, which the encoder drops.
    """
    indexes = [f"{c}_index" for c in features.categorical]
    onehots = [f"{c}_onehot" for c in features.categorical]
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features.numeric), outputCol="numeric"),
            StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
            StringIndexer(
                inputCols=list(features.categorical),
                outputCols=indexes,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexes, outputCols=onehots, dropLast=True),
            VectorAssembler(inputCols=["scaled", *onehots], outputCol="features"),
            VectorAssembler(inputCols=["numeric", *indexes], outputCol="indexed"),
        ]
    )


def scaled_numerics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with standardised columns, dividing by the population deviation.

    MLlib divides by the sample deviation; the factor between the two is the square root of
    ``n / (n - 1)``.
    """
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
    ]
    rows = df.count()
    factor = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    scaled = Pipeline(stages=stages).fit(df).transform(df)
    values = vector_to_array("_scaled")
    return scaled.withColumns(
        {c: values[i] * F.lit(factor) for i, c in enumerate(columns)}
    ).drop("_numeric", "_scaled")


def onehot_widths(df: DataFrame, features: FeatureSet = FULL) -> DataFrame:
    """Number of one-hot columns each categorical feature gets when fitted on ``df``."""
    sizes = dictionary(df, features.categorical).sizes
    return df.sparkSession.createDataFrame(list(sizes.items()), "feature string, width int")


def feature_names(encoded: DataFrame, features: FeatureSet) -> list[str]:
    """Names of the vector's entries in order, read from its metadata.

    The scaler numbers its outputs, so the leading entries take the numeric columns' names.
    """
    attributes = encoded.schema["features"].metadata["ml_attr"]["attrs"]
    entries = sorted(
        (entry for group in attributes.values() for entry in group), key=lambda e: e["idx"]
    )
    names = [entry["name"] for entry in entries]
    names[: len(features.numeric)] = list(features.numeric)
    return [name.replace("_onehot_", "_", 1) for name in names]


def regressors(
    trees: int = 100, depth: int = 5, seed: int = SEED, bins: int = 32
) -> dict[str, Estimator]:
    return {
        "linear_regression": LinearRegression(labelCol=DELAY_TARGET),
        "random_forest": RandomForestRegressor(
            labelCol=DELAY_TARGET,
            numTrees=trees,
            maxDepth=depth,
            featureSubsetStrategy="all",
            featuresCol="indexed",
            maxBins=bins,
            maxMemoryInMB=1024,
            seed=seed,
        ),
    }


def classifiers(
    rows: int, trees: int = 100, depth: int = 5, seed: int = SEED, bins: int = 32
) -> dict[str, Estimator]:
    """Logistic regression with a unit penalty on the summed loss, and a random forest."""
    return {
        "logistic_regression": LogisticRegression(
            labelCol=CLASS_TARGET, maxIter=1000, regParam=1.0 / max(rows, 1), standardization=False
        ),
        "random_forest": RandomForestClassifier(
            labelCol=CLASS_TARGET,
            numTrees=trees,
            maxDepth=depth,
            featuresCol="indexed",
            maxBins=bins,
            maxMemoryInMB=1024,
            seed=seed,
        ),
    }


@dataclass
class Trained:
    """A fitted model with its holdout metrics."""

    task: str
    name: str
    model: PipelineModel
    metrics: dict[str, float]
    params: dict[str, str] = field(default_factory=dict)
    importances: list[tuple[str, float]] = field(default_factory=list)
    trivial: float = 0.0


def _train(
    task: str,
    split: DataFrame,
    features: FeatureSet,
    trees: int,
    depth: int,
    seed: int,
) -> list[Trained]:
    """Fits each model of a task on the training rows and measures it on the held-out ones.

    Encodings are fitted on training rows only; rows are kept for the passes of all fits
    (spilling to disk; a lost block is recomputed).
    """
    target = DELAY_TARGET if task == "regression" else CLASS_TARGET
    features = features.present(split)
    rows = split.select(*features.columns, "is_test", F.col(target).cast("double").alias(target))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, held_out = rows.where(~F.col("is_test")), rows.where("is_test")
        fitted = {}
        name, model = _linear(task, train, features, target)
        fitted[name] = (model, [])
        fitted["random_forest"] = _forest(task, train, features, target, trees, depth, seed)
        trivial = _trivial(task, held_out, target)
        return [
            Trained(
                task, name, model, _evaluate(task, predict(model, held_out), target),
                {"features": ",".join(features.columns), "random_state": str(seed)}, importances, trivial,
            )
            for name, (model, importances) in fitted.items()
        ]
    finally:
        rows.unpersist()


def _linear(task: str, train: DataFrame, features: FeatureSet, target: str) -> tuple[str, PipelineModel]:
    """The linear model of a task, from its normal equations; of a one-hot design too wide for
    these, from MLlib's iterative solvers."""
    name = "linear_regression" if task == "regression" else "logistic_regression"
    try:
        if task == "regression":
            return name, linear.least_squares(train, features.numeric, features.categorical, target).regressor()
        return name, linear.logistic(train, features.numeric, features.categorical, target).classifier()
    except linear.TooManyColumns:
        encoding = preprocessor(features).fit(train)
        estimators = regressors() if task == "regression" else classifiers(train.count())
        return name, PipelineModel([*encoding.stages, estimators[name].fit(encoding.transform(train))])


class ForestMean(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Joins the forests of which each ``<prefix><n>`` column comes, by the numbers of their trees:
    ``prediction`` is the mean of their predictions or, of class probabilities, ``probability_1`` is
    their mean and ``prediction`` 1.0 where that is above one half. It is what one forest of all
    the trees gives."""

    weights = Param(Params._dummy(), "weights", "trees of each forest", TypeConverters.toListFloat)
    prefix = Param(Params._dummy(), "prefix", "columns to join", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "whether they are class probabilities", TypeConverters.toBoolean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, classes = self.getOrDefault("weights"), self.getOrDefault("classes")
        names = [f"{self.getOrDefault('prefix')}{i}" for i in range(len(weights))]
        mean = F.lit(0.0)
        for name, weight in zip(names, weights, strict=True):
            mean = mean + F.lit(weight / sum(weights)) * (class_probability(name) if classes else F.col(name))
        if not classes:
            return dataset.withColumn("prediction", mean).drop(*names)
        joined = dataset.withColumn("probability_1", mean).drop(*names)
        return joined.withColumn("prediction", (F.col("probability_1") > 0.5).cast("double"))


def _forest(
    task: str, train: DataFrame, features: FeatureSet, target: str, trees: int, depth: int, seed: int
) -> tuple[PipelineModel, list[tuple[str, float]]]:
    """A forest over plain numbers and category bins, with its importances. The number of bins is
    bounded, however many values a category has. It is grown TREES_AT_ONCE trees at a time, each
    on all rows."""
    bins, most = fit_bins(train, features.categorical, target)
    names, classes, per_feature = [*features.numeric, *bins.columns], task != "regression", max(32, most)
    assembler = VectorAssembler(inputCols=names, outputCol="indexed")
    # Bins are whole numbers below ``most``.
    cuts = [*forest.cuts(train, features.numeric, per_feature), *[np.arange(most - 1) + 0.5] * len(bins.columns)]
    chunks = forest.binned(bins.transform(train), names, target, cuts)
    sizes = [min(TREES_AT_ONCE, trees - at) for at in range(0, trees, TREES_AT_ONCE)]
    grown, values = [], 0.0
    for i, size in enumerate(sizes):
        made = classifiers(0, size, depth, seed + i, per_feature) if classes else regressors(size, depth, seed + i, per_feature)
        model = forest.grow(chunks, cuts, made["random_forest"], classes, size, depth, seed + i, classes and trees > 1)
        model.setPredictionCol("" if classes else f"_forest_{i}")
        if classes:
            model.setRawPredictionCol("").setProbabilityCol(f"_forest_{i}")
        grown.append(model)
        # A tree's importances sum to 1, so a forest's count as often as it has trees.
        values = values + model.featureImportances.toArray() * size / trees
    joined = ForestMean()
    joined._set(weights=[float(size) for size in sizes], prefix="_forest_", classes=classes)
    total = values.sum() or 1.0
    names = [*features.numeric, *features.categorical]
    importances = sorted(zip(names, (values / total).tolist(), strict=True), key=lambda p: p[1], reverse=True)
    return PipelineModel([bins, assembler, *grown, joined]), importances


def _trivial(task: str, held_out: DataFrame, target: str) -> float:
    """What the trivial model scores on the held-out rows: the squared error of their mean, or the
    share of their larger class."""
    if task == "regression":
        return held_out.agg(F.var_pop(target)).first()[0] or 0.0
    late = held_out.agg(F.avg(target)).first()[0] or 0.0
    return max(late, 1 - late)


def _evaluate(task: str, scored: DataFrame, target: str) -> dict[str, float]:
    if task == "regression":
        return metrics.regression_metrics(scored, target).first().asDict()
    # The area takes several passes: the rows are scored for the first alone.
    ranked = written_once(scored.select(target, "prediction", F.col("probability_1").alias("_score")), "scored")
    return {
        "accuracy": metrics.accuracy(ranked, target).first()["accuracy"],
        "roc_auc": metrics.roc_auc(ranked, target, "_score"),
    }


def class_probability(column: str = "probability") -> Column:
    """Probability of class 1."""
    return vector_to_array(column)[1]


def train_regression(
    prepared: DataFrame,
    features: FeatureSet = FULL,
    test_size: float = TEST_SIZE,
    trees: int = 100,
    depth: int = 5,
    seed: int = SEED,
) -> list[Trained]:
    """Linear regression and random forest on a hash split. ``prepared`` is worked out once."""
    split = split_hash(written_once(prepared, "prepared"), test_size)
    return _train("regression", split, features, trees, depth, seed)


def train_classification(
    prepared: DataFrame,
    features: FeatureSet = FULL,
    test_size: float = TEST_SIZE,
    trees: int = 100,
    depth: int = 5,
    seed: int = SEED,
) -> list[Trained]:
    """Logistic regression and random forest on a split that keeps the class shares. ``prepared``
    is read several times to split it, so it is worked out once."""
    split = split_stratified(written_once(prepared, "prepared"), CLASS_TARGET, test_size)
    return _train("classification", split, features, trees, depth, seed)


def metrics_table(spark: SparkSession, trained: Sequence[Trained]) -> DataFrame:
    """One row per task, model and metric."""
    rows = [(t.task, t.name, m, float(v)) for t in trained for m, v in t.metrics.items()]
    return spark.createDataFrame(rows, "task string, model string, metric string, value double")


def checks(trained: Sequence[Trained], spark: SparkSession) -> DataFrame:
    """Whether each model beats the trivial one on held-out rows, and importances sum to 1, with
    the trivial model's score.

    The trivial regression predicts the mean (its squared error), the trivial classification the
    larger class (its accuracy).
    """
    rows = []
    for t in trained:
        trivial = round(t.trivial, 6)
        if t.task == "regression":
            rows.append((t.task, t.name, "better than the mean", t.metrics["mse"] < t.trivial, trivial))
        else:
            better = t.metrics["accuracy"] > t.trivial - 0.01
            rows.append((t.task, t.name, "better than the larger class", better, trivial))
        if t.importances:
            total = sum(v for _, v in t.importances)
            rows.append((t.task, t.name, "importances sum to 1", abs(total - 1) < 1e-6, trivial))
    schema = "task string, model string, check string, passed boolean, trivial_score double"
    return spark.createDataFrame(rows, schema)


def fit_line(df: DataFrame, column: str):
    """Least-squares line of the arrival delay on one column, over rows that have both."""
    rows = df.where(F.col(column).isNotNull() & F.col(DELAY_TARGET).isNotNull())
    vectors = VectorAssembler(inputCols=[column], outputCol="features").transform(rows)
    return LinearRegression(labelCol=DELAY_TARGET, solver="normal").fit(vectors)


def importance_table(spark: SparkSession, trained: Sequence[Trained]) -> DataFrame:
    """Named importances of the tree models, highest first within each task."""
    rows = [
        (t.task, t.name, position + 1, name, float(value))
        for t in trained
        for position, (name, value) in enumerate(t.importances)
    ]
    schema = "task string, model string, position int, feature string, importance double"
    return spark.createDataFrame(rows, schema).orderBy("task", "position")


def log_runs(
    spark: SparkSession,
    trained: Sequence[Trained],
    path: str,
    feature_version: int | None = None,
    started_at: datetime | None = None,
    save_models: bool = False,
) -> DataFrame:
    """Appends one row per model to the run table, with the feature table's version.

    With ``save_models`` the fitted pipelines are stored next to it.
    """
    when = started_at or datetime.now(UTC)
    rows = []
    for t in trained:
        run = uuid.uuid4().hex
        location = None
        if save_models:
            location = f"{path}/models/{run}"
            t.model.write().overwrite().save(location)
        params = {**t.params, "model_type": t.task, "model_name": t.name}
        numbers = {k: float(v) for k, v in t.metrics.items()}
        rows.append(
            (run, f"{t.task}_{t.name}", when, params, numbers, feature_version, location)
        )
    schema = (
        "run_id string, run_name string, started_at timestamp, params map<string,string>, "
        "metrics map<string,double>, feature_version int, model_path string"
    )
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/runs")
    return spark.read.parquet(f"{path}/runs")


def predict(model: Transformer, rows: DataFrame) -> DataFrame:
    """Rows with ``prediction`` and, for a classifier, ``probability_1``."""
    scored = model.transform(rows)
    if "probability" in scored.columns and "probability_1" not in scored.columns:
        scored = scored.withColumn("probability_1", class_probability())
    return scored
