"""Forests from sums over binned rows, against the rows themselves."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from windrow.operators import forest, models


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(7)
    made = [(float(random.randint(0, 9)), random.random(), float(random.randint(0, 3))) for _ in range(700)]
    made = [(a, b, c, a * 3 + (b > 0.4) * 10 - c + random.random()) for a, b, c in made]
    return spark.createDataFrame(made, "a double, b double, c double, y double").repartition(3).cache()


def test_cuts_lie_between_values_or_share_out_the_rows(rows):
    a, b = forest.cuts(rows, ["a", "b"], 20)
    assert a.tolist() == [i + 0.5 for i in range(9)]
    values = sorted(r["b"] for r in rows.collect())
    assert len(b) == 19
    for share, cut in enumerate(b, 1):
        assert sum(v <= cut for v in values) == pytest.approx(700 * share / 20, abs=1)


def test_summaries_of_many_values_still_share_out_the_rows(spark, monkeypatch):
    monkeypatch.setattr(forest, "SUMMARY", 200)
    monkeypatch.setattr(forest, "SORTED_AT_ONCE", 10_000)
    df = spark.range(0, 60_000, numPartitions=2).selectExpr("(id * 7919) % 60000 + 0.5D as x")
    (cuts,) = forest.cuts(df, ["x"], 8)
    assert cuts.tolist() == pytest.approx([7_500 * i for i in range(1, 8)], abs=1_200)


def test_groups_of_features_stay_below_the_limit():
    sizes = [32, 32, 5, 7, 256, 24, 12]
    groups = forest.together(sizes, 1_024)
    assert sorted(f for g in groups for f in g) == list(range(7))
    assert all(len(g) == 1 or np.prod([sizes[f] for f in g]) <= 1_024 for g in groups)


def test_portions_hold_every_node_once():
    nodes = [[4, 5, 6], [], [2, 3]]
    found = list(forest.portions(nodes, 10, 40))
    assert len(found) > 1 and [sum((p[t] for p in found), []) for t in range(3)] == nodes


def _weights(chunk: int, size: int, seed: int, trees: int) -> np.ndarray:
    """How often each tree sees each row of a chunk."""
    raw = np.random.SFC64([seed, chunk]).random_raw(-(-trees * size // 4)).view(np.uint16)
    raw = raw[: trees * size].reshape(trees, size)
    return np.sum([raw >= n for n in forest._poisson()], axis=0)


def _tree(x, y, w, sizes, depth):
    """Predicts each row by the best cut of all, tried one by one."""
    out, mean = np.full(len(y), 0.0), (w @ y) / w.sum()
    best, at = 1e-9, None
    for f, size in enumerate(sizes if depth else []):
        for last in range(size - 1):
            left = x[f] <= last
            if not w[left].sum() or not w[~left].sum():
                continue
            means = [(w[s] @ y[s]) / w[s].sum() for s in (left, ~left)]
            gain = sum(w[s].sum() * (m - mean) ** 2 for s, m in zip((left, ~left), means)) / w.sum()
            if gain > best + 1e-9:
                best, at = gain, left
    if at is None:
        return out + mean
    for side in (at, ~at):
        out[side] = _tree([c[side] for c in x], y[side], w[side], sizes, depth - 1)
    return out


@pytest.mark.parametrize("classes", [False, True])
@pytest.mark.parametrize("cells", [1 << 23, 1])
def test_trees_are_those_of_the_rows(rows, monkeypatch, classes, cells):
    monkeypatch.setattr(forest, "CHUNK_ROWS", 100)
    monkeypatch.setattr(forest.portions, "__defaults__", (cells,))
    df = rows.selectExpr("a", "b", "c", "cast(y > 20 as double) as y") if classes else rows
    thresholds = [*forest.cuts(df, ["a", "b"], 8), np.arange(3) + 0.5]
    sizes = [len(t) + 1 for t in thresholds]
    chunks = forest.binned(df, ["a", "b", "c"], "y", thresholds)
    made = models.classifiers(0, 2, 3, 5) if classes else models.regressors(2, 3, 5)
    model = forest.grow(chunks, thresholds, made["random_forest"], classes, 2, 3, 5)
    assert model.getNumTrees == 2 and model.featureImportances.toArray().sum() == pytest.approx(1.0)
    parts = sorted(chunks.collect(), key=lambda r: r["chunk"])
    assert len(parts) > 3
    x = np.concatenate([np.frombuffer(r["codes"], np.uint8).reshape(3, -1) for r in parts], axis=1)
    y = np.concatenate([np.frombuffer(r["targets"]) for r in parts])
    w = np.concatenate([_weights(r["chunk"], len(r["targets"]) // 8, 5, 2) for r in parts], axis=1).astype(float)
    assert 0.9 < w.mean() < 1.1
    # A value of each bin: the cut above it, or one more than the last.
    values = [np.append(t, t[-1] + 1)[c] for t, c in zip(thresholds, x)]
    for t in range(2):
        wanted = _tree(list(x), y, w[t], sizes, 3)
        for i in range(0, len(y), 23):
            vector = Vectors.dense([v[i] for v in values])
            tree = model.trees[t]
            if classes:
                assert tree.predict(vector) == float(wanted[i] > 0.5)
            else:
                assert tree.predict(vector) == pytest.approx(wanted[i])


def test_a_forest_reads_its_rows_once_for_each_level(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("forest", "forest")
    try:
        models._forest("regression", rows, models.FeatureSet([], ["a", "b", "c"]), "y", 40, 3, 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("forest")) <= 20


def test_no_rows_are_an_error(spark):
    nothing = spark.createDataFrame([], "a double, y double")
    with pytest.raises(ValueError, match="no rows"):
        models._forest("regression", nothing, models.FeatureSet([], ["a"]), "y", 2, 2, 1)


def test_rows_with_nulls_are_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, y double")
    with pytest.raises(Exception, match="no nulls"):
        models._forest("regression", df, models.FeatureSet([], ["a"]), "y", 2, 2, 1)


def test_rows_are_scored_once_to_be_evaluated(spark):
    seen = spark.sparkContext.accumulator(0)

    def scored(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(i % 2 * 1.0, 1.0, i / 40) for i in range(40)], "y double, prediction double, probability_1 double")
    found = models._evaluate("classification", df.mapInArrow(scored, df.schema), "y")
    assert seen.value == 40
    assert found["accuracy"] == 0.5 and found["roc_auc"] == pytest.approx(0.525)
