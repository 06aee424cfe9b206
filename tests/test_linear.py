"""Linear fits against plain solvers, their equations, and category dictionaries and bins."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from windrow.operators import linear, models
from windrow.operators.categories import dictionary, fit_bins, with_indexes

NUMERIC, CATEGORICAL = ["x", "y"], ["c", "d"]


def made(n: int, seed: int = 1):
    made = random.Random(seed)
    out = []
    for i in range(n):
        c, d = made.choice("abc'\\"), made.randint(1, 4)
        x, y = made.gauss(50, 20), made.choice([1.0, 2.5])
        t = 3 * x - 7 * y + {"a": 1, "b": 5}.get(c, 0) + d + made.gauss(0, 3)
        out.append((f"{i:04d}", x, y, c, d, t, int(t + made.gauss(0, 30) > 140)))
    return out


SCHEMA = "id string, x double, y double, c string, d int, t double, late int"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(made(400), SCHEMA).cache()


def design_of(data, values):
    """One-hot columns beside scaled numbers."""
    columns = []
    for k in (1, 2):
        x = np.array([r[k] for r in data])
        columns.append((x - x.mean()) / x.std())
    for k, known in zip((3, 4), values, strict=True):
        columns += [np.array([float(str(r[k]) == v) for r in data]) for v in known]
    return np.array(columns).T


def values_of(data):
    return [sorted({str(r[k]) for r in data}) for k in (3, 4)]


def test_least_squares_equals_a_plain_solver(rows):
    data = made(400)
    fit = linear.least_squares(rows, NUMERIC, CATEGORICAL, "t")
    x, t = design_of(data, values_of(data)), np.array([r[5] for r in data])
    centred = x - x.mean(0)
    shortest = np.linalg.lstsq(centred, t - t.mean(), rcond=1e-10)[0]
    assert np.linalg.matrix_rank(centred, tol=1e-8) == fit.design.width - 2
    assert fit.coefficients == pytest.approx(shortest, abs=1e-8)
    assert fit.intercept == pytest.approx(t.mean() - x.mean(0) @ shortest, abs=1e-8)
    scored = {r["id"]: r["prediction"] for r in fit.regressor().transform(rows).collect()}
    assert [scored[r[0]] for r in data] == pytest.approx(list(x @ shortest + fit.intercept), abs=1e-6)


def test_unseen_values_and_constant_numbers(spark, rows):
    fit = linear.least_squares(rows, NUMERIC, CATEGORICAL, "t")
    new = spark.createDataFrame([("n", 50.0, 1.0, "never", 99, 0.0, 0)], SCHEMA)
    one = fit.regressor().transform(new).first()["prediction"]
    scaled = [(v - m) / s for v, (_, m, s) in zip((50.0, 1.0), fit.design.numeric, strict=True)]
    assert one == pytest.approx(fit.intercept + scaled @ fit.coefficients[:2])
    flat = linear.least_squares(rows.withColumn("x", F.lit(4.0)), NUMERIC, ["c"], "t")
    assert flat.coefficients[0] == 0 and np.isfinite(flat.coefficients).all()


def test_residuals_are_orthogonal_to_every_column(rows):
    fit = linear.least_squares(rows, NUMERIC, CATEGORICAL, "t")
    left = fit.regressor().transform(rows).withColumn("r", F.col("t") - F.col("prediction"))
    sums = linear.column_sums(left, fit.design, "r").collect()
    assert len(sums) == fit.design.width + 1 and max(abs(s["total"]) for s in sums) < 1e-8


def test_no_numbers_no_categories_and_no_rows(rows):
    means = linear.least_squares(rows, [], ["c"], "t")
    got = {r["c"]: r["p"] for r in means.regressor().transform(rows).groupBy("c").agg(F.first("prediction").alias("p")).collect()}
    assert got == pytest.approx({r["c"]: r["m"] for r in rows.groupBy("c").agg(F.avg("t").alias("m")).collect()})
    line = linear.least_squares(rows, ["x"], [], "t")
    slope, intercept = np.polyfit([r[1] for r in made(400)], [r[5] for r in made(400)], 1)
    assert line.coefficients[0] / line.design.numeric[0][2] == pytest.approx(slope)
    at_zero = line.intercept - line.coefficients[0] * line.design.numeric[0][1] / line.design.numeric[0][2]
    assert at_zero == pytest.approx(intercept)
    with pytest.raises(ValueError, match="no rows"):
        linear.least_squares(rows.limit(0), ["x"], ["c"], "t")
    with pytest.raises(linear.TooManyColumns):
        linear.least_squares(rows, NUMERIC, ["id"], "t", max_columns=100)


def plain_logistic(x, y, penalty):
    a = np.hstack([x, np.ones((len(x), 1))])
    pull = np.append(np.full(x.shape[1], penalty), 0.0)
    beta = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-a @ beta))
        information = a.T @ (a * (p * (1 - p))[:, None]) + np.diag(pull)
        beta = beta + np.linalg.solve(information, a.T @ (y - p) - pull * beta)
    return beta, np.sqrt(np.diag(np.linalg.inv(information)))


@pytest.mark.parametrize("penalty", [1.0, 30.0])
def test_logistic_equals_plain_newton(spark, rows, penalty):
    data = made(400)
    fit = linear.logistic(rows, NUMERIC, CATEGORICAL, "late", penalty)
    beta, errors = plain_logistic(design_of(data, values_of(data)), np.array([r[6] for r in data]), penalty)
    assert np.append(fit.coefficients, fit.intercept) == pytest.approx(beta, abs=1e-8)
    assert fit.errors == pytest.approx(errors, rel=1e-6) and fit.rounds < 15
    scored = models.predict(fit.classifier(), rows)
    assert scored.where((F.col("probability_1") > 0.5) != (F.col("prediction") == 1)).count() == 0
    table = fit.table(spark).collect()
    assert table[0]["feature"] == linear.INTERCEPT and len(table) == fit.design.width + 1


def test_separated_classes_stay_finite(spark):
    data = [(float(i), int(i >= 20)) for i in range(40)]
    fit = linear.logistic(spark.createDataFrame(data, "x double, late int"), ["x"], [], "late")
    assert np.isfinite(fit.coefficients).all() and fit.coefficients[0] > 0
    one_class = linear.logistic(spark.createDataFrame([(1.0, 1), (2.0, 1)], "x double, late int"), ["x"], [], "late")
    assert np.isfinite(one_class.intercept) and one_class.intercept > 3


def test_stages_reload(rows, tmp_path):
    fit = linear.logistic(rows, NUMERIC, CATEGORICAL, "late")
    fit.classifier().write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    pairs = zip(fit.classifier().transform(rows).collect(), again.transform(rows).collect(), strict=True)
    assert all(a == b for a, b in pairs)


def test_wide_designs_fall_back(spark, monkeypatch):
    monkeypatch.setattr(linear, "least_squares", lambda *a, **k: (_ for _ in ()).throw(linear.TooManyColumns()))
    data = spark.createDataFrame([(float(i), str(i % 3), 2.0 * i) for i in range(60)], f"x double, c string, {models.DELAY_TARGET} double")
    name, model = models._linear("regression", data, models.FeatureSet(["c"], ["x"]), models.DELAY_TARGET)
    assert name == "linear_regression"
    worst = model.transform(data).agg(F.max(F.abs(F.col("prediction") - F.col(models.DELAY_TARGET)))).first()[0]
    assert worst < 0.1


def test_dictionary_numbers_values_in_order(spark):
    data = [("b", 2, "x"), ("a", 10, "x"), (None, 2, "y"), ("b", None, "x"), ("é", 1, None)]
    df = spark.createDataFrame(data, "p string, q int, r string")
    found = dictionary(df, ["p", "q", "r"])
    got = {(r["feature"], r["value"]): r["index"] for r in found.table.collect()}
    assert got == {
        ("p", "a"): 0, ("p", "b"): 1, ("p", "é"): 2, ("q", "1"): 0, ("q", "10"): 1, ("q", "2"): 2, ("r", "x"): 0, ("r", "y"): 1,
    }
    assert found.sizes == {"p": 3, "q": 3, "r": 2}
    indexed = with_indexes(df, found, {"p": "i", "q": "j"}).collect()
    assert sorted((r["p"] or "", r["i"], r["q"], r["j"]) for r in indexed if r["q"] and r["p"]) == [("a", 0, 10, 1), ("b", 1, 2, 2), ("é", 2, 1, 0)]
    assert [r["i"] for r in indexed if r["p"] is None] == [None]
    assert dictionary(df.limit(0), ["p"]).sizes == {"p": 0} and dictionary(df, []).table.count() == 0


def test_a_column_of_many_values_has_no_driver_list(spark):
    df = spark.range(300_000).select(F.sha1(F.col("id").cast("string")).alias("v"))
    found = dictionary(df, ["v"])
    assert found.sizes == {"v": 300_000}
    numbered = with_indexes(df, found, {"v": "i"})
    distinct, low, high = numbered.agg(F.count_distinct("i"), F.min("i"), F.max("i")).first()
    assert (distinct, low, high) == (300_000, 0, 299_999)
    wrong = numbered.alias("a").join(numbered.alias("b"), F.col("a.i") == F.col("b.i") - 1).where("a.v >= b.v")
    assert wrong.count() == 0


def test_bins_follow_the_target(spark, tmp_path):
    data = [("low", 1.0), ("low", 3.0), ("high", 9.0), ("mid", 5.0), ("mid2", 5.0), (None, 4.0)]
    df = spark.createDataFrame(data, "c string, t double")
    bins, most = fit_bins(df, ["c"], "t")
    assert most == 4
    assert {r["value"]: r["bin"] for r in bins.table.collect()} == {"low": 0.0, "mid": 1.0, "mid2": 2.0, "high": 3.0}
    new = spark.createDataFrame([("mid",), ("never",), (None,)], "c string")
    # The mean of the rows with a value is 4.6: what is not known goes with the last bin below.
    assert [r["c_bin"] for r in bins.transform(new).collect()] == [1.0, 0.0, 0.0]
    PipelineModel([bins]).write().save(str(tmp_path / "bins"))
    again = PipelineModel.load(str(tmp_path / "bins"))
    assert [r["c_bin"] for r in again.transform(new).collect()] == [1.0, 0.0, 0.0]


def test_many_values_share_bins_of_equal_size(spark):
    df = spark.range(40_000).select(
        F.concat(F.lit("v"), F.col("id") % 10_000).alias("c"), (F.col("id") % 10_000).cast("double").alias("t"), F.lit("one").alias("k")
    )
    bins, most = fit_bins(df, ["c", "k"], "t", at_most=64)
    assert most == 64
    counts = bins.transform(df).groupBy("c_bin").agg(F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high")).orderBy("c_bin").collect()
    assert [r["c_bin"] for r in counts] == list(range(64))
    assert max(r["n"] for r in counts) <= 40_000 / 64 + 8
    assert all(a["high"] < b["low"] for a, b in zip(counts, counts[1:]))
    assert bins.transform(df).select("k_bin").distinct().collect()[0]["k_bin"] == 0.0
    assert fit_bins(df, [], "t")[1] == 0
