"""Preparation, training and metrics of the delay models."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from windrow.operators import features, metrics, models, selection
from windrow.plans.queries import _features, _raw


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    return models.prepare(_features(spark, sf_dir)).cache()


@pytest.fixture(scope="module")
def regression(prepared):
    return models.train_regression(prepared, trees=5)


@pytest.fixture(scope="module")
def classification(prepared):
    return models.train_classification(prepared, trees=5)


def test_prepare_drops_nulls_and_missing_features(flights):
    df = features.features_simple(flights({}, {"Origin": None}), limit=None)
    ready = models.prepare(df.drop("SEASON"), models.SIMPLE)
    assert ready.count() == 1 and "SEASON" not in ready.columns


def test_unseen_category_encodes_as_zeros(spark):
    small = models.FeatureSet(["c"], ["x"])
    train = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "c string, x double")
    fitted = models.preprocessor(small).fit(train)
    test = spark.createDataFrame([("b", 2.0), ("z", 2.0)], "c string, x double")
    encoded = fitted.transform(test)
    vectors = [r[0] for r in encoded.select(vector_to_array("features")).collect()]
    assert vectors == [[0.0, 0.0, 1.0], [0.0, 0.0, 0.0]]
    assert models.feature_names(encoded, small) == ["x", "c_a", "c_b"]


def test_population_scaling(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    values = [r["x"] for r in models.scaled_numerics(df, ["x"]).collect()]
    assert values == pytest.approx([-1.0, 1.0])


def test_linear_model_beats_the_mean(prepared, regression):
    test = selection.split_hash(prepared).where("is_test")
    spread = test.agg(F.stddev_pop(models.DELAY_TARGET)).first()[0]
    by_name = {t.name: t.metrics for t in regression}
    assert by_name["linear_regression"]["rmse"] < spread / 2
    assert by_name["random_forest"]["rmse"] < spread
    assert 0 < by_name["random_forest"]["r2"] < by_name["linear_regression"]["r2"] <= 1


def test_classifiers_beat_the_larger_class(prepared, classification):
    late = prepared.agg(F.avg(models.CLASS_TARGET)).first()[0]
    for trained in classification:
        assert trained.metrics["accuracy"] > max(late, 1 - late)
        assert 0.5 < trained.metrics["roc_auc"] <= 1


def test_importances_are_named_and_sum_to_one(spark, regression, classification):
    for trained in (regression[1], classification[1]):
        names = [n for n, _ in trained.importances]
        values = [v for _, v in trained.importances]
        assert sum(values) == pytest.approx(1.0) and values == sorted(values, reverse=True)
        assert len(set(names)) == len(names) and names[0] == "DepDelay"
        assert set(names) == set(models.FULL.columns)
    table = models.importance_table(spark, regression).collect()
    assert table[0]["position"] == 1 and table[0]["feature"] == "DepDelay"


def test_predict_gives_the_probability_of_class_one(prepared, classification):
    scored = models.predict(classification[0].model, prepared).select(
        "prediction", "probability_1"
    )
    assert scored.where(
        (F.col("prediction") == 1) != (F.col("probability_1") > 0.5)
    ).count() == 0


def test_runs_are_appended_and_models_reload(spark, tmp_path, prepared, regression):
    path = str(tmp_path / "ml")
    models.log_runs(spark, regression, path, feature_version=3)
    runs = models.log_runs(spark, regression, path, feature_version=4, save_models=True)
    rows = runs.collect()
    assert len(rows) == 4 and {r["feature_version"] for r in rows} == {3, 4}
    assert {r["run_name"] for r in rows} == {
        "regression_linear_regression", "regression_random_forest",
    }
    saved = next(r for r in rows if r["model_path"] and "linear" in r["run_name"])
    assert saved["metrics"]["rmse"] > 0 and "Distance" in saved["params"]["features"]
    again = models.PipelineModel.load(saved["model_path"])
    assert again.transform(prepared).where("prediction IS NULL").count() == 0


def test_metrics_match_brute_force(spark):
    random.seed(3)
    pairs = [(random.randint(0, 1), float(random.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "y int, s double")
    wins = sum(
        1.0 if p > n else 0.5 if p == n else 0.0
        for y, p in pairs if y for z, n in pairs if not z
    )
    positives = sum(y for y, _ in pairs)
    expected = wins / (positives * (len(pairs) - positives))
    assert metrics.roc_auc(df, "y", "s") == pytest.approx(expected, abs=1e-12)
    row = metrics.regression_metrics(df, "s", "y").first()
    mse = sum((s - y) ** 2 for y, s in pairs) / len(pairs)
    mean = sum(s for _, s in pairs) / len(pairs)
    spread = sum((s - mean) ** 2 for _, s in pairs) / len(pairs)
    assert row["mse"] == pytest.approx(mse) and row["rmse"] == pytest.approx(mse**0.5)
    assert row["r2"] == pytest.approx(1 - mse / spread)
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "y double, prediction double")
    assert metrics.regression_metrics(constant, "y").first()["r2"] is None


def test_simple_feature_set_trains(spark, sf_dir):
    rows = models.prepare(features.features_simple(_raw(spark, sf_dir)), models.SIMPLE)
    trained = models.train_regression(rows, models.SIMPLE, trees=2, depth=3)
    table = models.metrics_table(spark, trained)
    assert {r["metric"] for r in table.collect()} == {"mse", "rmse", "r2"}


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_a_forest_grown_in_parts_is_their_mean(spark, prepared, tmp_path, monkeypatch, task):
    monkeypatch.setattr(models, "TREES_AT_ONCE", 2)
    few = models.FeatureSet(["AIRLINE"], ["DepDelay", "Distance"])
    target = models.DELAY_TARGET if task == "regression" else models.CLASS_TARGET
    rows = prepared.select(*few.columns, F.col(target).cast("double").alias(target))
    model, importances = models._forest(task, rows, few, target, 5, 3, 7)
    parts = model.stages[2:-1]
    assert [p.getNumTrees for p in parts] == [2, 2, 1]
    assert sum(v for _, v in importances) == pytest.approx(1.0) and importances[0][0] == "DepDelay"
    model.write().overwrite().save(str(tmp_path / "forest"))
    again = models.PipelineModel.load(str(tmp_path / "forest"))
    encoded = models.PipelineModel(model.stages[:2]).transform(rows)
    scored = models.predict(again, rows)
    column = "prediction" if task == "regression" else "probability_1"
    for row, found in zip(encoded.limit(20).collect(), scored.limit(20).collect(), strict=True):
        x = row["indexed"]
        each = [p.predict(x) if task == "regression" else p.predictProbability(x)[1] for p in parts]
        assert found[column] == pytest.approx(sum(e * p.getNumTrees for e, p in zip(each, parts)) / 5)
    assert set(scored.columns) - set(encoded.columns) <= {"prediction", "probability_1"}
