from __future__ import annotations

import itertools

import numpy as np
import pytest
from made_up import prose

from windrow.llm import quality_crf as q


def test_forward_backward_against_enumeration():
    some = np.random.default_rng(0)
    for n in (1, 2, 5):
        scores, moves = some.standard_normal(n), some.standard_normal((2, 2))
        weight = {}
        for labels in itertools.product((0, 1), repeat=n):
            value = sum(scores[t] for t in range(n) if labels[t])
            weight[labels] = np.exp(value + sum(moves[a, b] for a, b in itertools.pairwise(labels)))
        total = sum(weight.values())
        wanted = [sum(w for l, w in weight.items() if l[t]) / total for t in range(n)]
        good, expected, log_total = q._forward_backward(scores[None], np.ones((1, n), dtype=bool), moves)
        assert np.allclose(good[0], wanted) and np.isclose(log_total, np.log(total))
        assert np.isclose(expected.sum(), n - 1)


def test_padding_and_grouping_change_nothing():
    some = np.random.default_rng(1)
    counts = np.array([3, 1, 70, 2, 9])
    model = q.LineModel(some.standard_normal(4), some.standard_normal((2, 2)))
    inputs = some.standard_normal((counts.sum(), 4))
    together, at = model.marginals(inputs, counts), 0
    for count in counts:
        alone = model.marginals(inputs[at : at + count], np.array([count]))
        assert np.allclose(together[at : at + count], alone)
        at += count


def test_line_features():
    own, sizes, counts = q.line_features(["AB!\n\n|x x", "", "é 1"])
    assert counts.tolist() == [3, 1, 1] and sizes.tolist() == [4, 1, 5, 1, 5]
    named = {name: own[:, i] for i, name in enumerate(q.FEATURES)}
    assert named["upper"][0] == pytest.approx(2 / 3) and named["exclamation"][0] == pytest.approx(1 / 3)
    assert named["blank"].tolist() == [0, 1, 0, 1, 0]
    assert named["not_ascii"][4] == pytest.approx(0.5)
    wide = q.with_neighbours(own, counts)
    assert (wide[0, own.shape[1] : 2 * own.shape[1]] == 0).all()
    assert (wide[2, 2 * own.shape[1] :] == 0).all()


def labelled(make_docs, spark):
    rows, marks = [], []
    for k in range(200):
        good = k % 2
        text = "\n".join(f"{prose(3 * k + i, 12)}." for i in range(3))
        rows.append((k, text if good else text.upper().replace(" ", "!! ")))
        marks.append((k, good))
    return make_docs(rows, extra=True), spark.createDataFrame(marks, "doc_id bigint, quality int")


def test_held_out_accuracy(spark, make_docs):
    docs, labels = labelled(make_docs, spark)
    model = q.train(docs, labels)
    result = q.score_documents(docs, model).withColumn("held_out", q.in_held_out()).join(labels, "doc_id")
    held = [r for r in result.collect() if r["held_out"]]
    assert len(held) > 20
    assert np.mean([(r["score"] >= q.THRESHOLD) == r["quality"] for r in held]) > 0.95


def test_held_out_labels_are_not_used(spark, make_docs):
    docs, labels = labelled(make_docs, spark)
    turned = labels.withColumn("quality", q.F.when(q.in_held_out(), 1 - q.F.col("quality")).otherwise(q.F.col("quality")))
    assert np.array_equal(q.train(docs, labels).weights, q.train(docs, turned).weights)


def test_the_sample_is_bounded(spark, make_docs, monkeypatch):
    docs, labels = labelled(make_docs, spark)
    seen = []
    monkeypatch.setattr(q, "fit", lambda inputs, counts, labels: seen.append(counts) or q.LineModel(np.zeros(3 * len(q.FEATURES)), np.zeros((2, 2))))
    q.train(docs, labels, max_docs=10)
    q.train(docs, labels, max_lines=7)
    assert len(seen[0]) == 10 and seen[1].sum() <= 7


def test_one_very_long_text_does_not_void_the_model(spark, make_docs):
    docs, labels = labelled(make_docs, spark)
    for extra in (7001, 7002, 7003):
        docs = docs.unionByName(make_docs([(extra, "x y\n" * 200_000)], extra=True))
        labels = labels.union(spark.createDataFrame([(extra, 1)], labels.schema))
    model = q.train(docs, labels)
    assert np.abs(model.weights).max() > 0
    plain = labelled(make_docs, spark)
    assert np.array_equal(model.weights, q.train(*plain).weights)


def test_a_sample_of_one_label_is_an_error(spark, make_docs):
    docs = make_docs([(k, "a line\n" * (1 if k % 2 else 30)) for k in range(60)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, quality int")
    with pytest.raises(ValueError, match="both labels"):
        q.train(docs, labels, max_lines=5)


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame(
        [(3, 1), (4, 0), (4, 1), (None, 1), (5, None), (6, 0), (11, 1)], "doc_id bigint, quality int"
    )
    model = q.train(odd_docs, labels)
    rows = q.score_documents(odd_docs, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert q.score_documents(no_docs, model).count() == 0
    nothing = q.train(no_docs, labels.limit(0))
    assert {r["score"] for r in q.score_documents(odd_docs, nothing).collect()} == {0.5}
    with pytest.raises(ValueError):
        q.score_documents(odd_docs, model, keep=True)
    assert q.score_documents(odd_docs, model, keep=True, score_column="fresh").columns == [*odd_docs.columns, "fresh"]
