from __future__ import annotations

import pytest
from made_up import plan_of, prose
from pyspark.sql import functions as F

from windrow.llm import mixing

EXPONENTS = {"source": 0.5, "lang": 0.5, "topic": 1.0}


@pytest.fixture(scope="module")
def many(make_docs):
    rows = []
    for k in range(600):
        text = prose(k, 20 + k % 30)
        if k % 7 == 0:
            text = text.replace(" ", " | ")
        rows.append((k, text, "en" if k % 3 else "de", "hot" if k % 2 else f"src{k % 5}", 0))
    return make_docs(rows, extra=False)


def test_weights_meet_the_targets(many):
    labelled = mixing.label_documents(many)
    cells = labelled.groupBy(*mixing.MARGINS).agg(F.sum("n_tokens").alias("n"))
    targets = {m: mixing.flattened_targets(cells, m, e) for m, e in EXPONENTS.items()}
    fitted = mixing.rake(cells, targets, rounds=30)
    for margin in mixing.MARGINS:
        wanted = {r[margin]: r["target"] for r in targets[margin].collect()}
        found = {r[margin]: r["s"] for r in fitted.groupBy(margin).agg(F.sum("w").alias("s")).collect()}
        assert found == pytest.approx(wanted, abs=1e-6)


def test_missing_and_extra_labels(many, spark):
    cells = mixing.label_documents(many).groupBy(*mixing.MARGINS).agg(F.sum("n_tokens").alias("n"))
    target = spark.createDataFrame([("en", 0.5), ("xx", 0.5)], "lang string, target double")
    fitted = mixing.rake(cells, {"lang": target}, rounds=5)
    assert {r["lang"]: round(r["s"], 9) for r in fitted.groupBy("lang").agg(F.sum("w").alias("s")).collect()} == {"en": 1.0, "de": 0.0}


def test_draws_follow_the_probabilities(many):
    low = {r["doc_id"] for r in mixing.mix_documents(many, EXPONENTS, 0.3).collect()}
    high = mixing.mix_documents(many, EXPONENTS, 0.6).collect()
    assert low <= {r["doc_id"] for r in high} and 60 < len(low) < len(high) < 600
    assert all(0 < r["probability"] <= 1 for r in high)
    again = mixing.mix_documents(many.repartition(5), EXPONENTS, 0.3).collect()
    assert low == {r["doc_id"] for r in again}
    assert "Python" not in plan_of(mixing.mix_documents(many, EXPONENTS, 0.3))


def test_odd_documents(odd_docs, odd_rows, no_docs):
    everything = mixing.mix_documents(odd_docs, {m: 1.0 for m in mixing.MARGINS}, 1.0)
    assert everything.count() == len(odd_rows)
    assert mixing.mix_documents(no_docs, EXPONENTS, 0.5).count() == 0


def test_topics(make_docs):
    rows = [(1, "a | b | c"), (2, "HELLO WORLD now"), (3, "word word"), (4, None), (5, "a ### b $$$"), (6, "12 345 x")]
    found = {r["doc_id"]: (r["topic"], r["n_tokens"]) for r in mixing.label_documents(make_docs(rows)).collect()}
    assert found == {1: ("tables", 6), 2: ("shouting", 4), 3: ("prose", 3), 4: ("prose", 1), 5: ("markup", 5), 6: ("figures", 4)}


def test_null_labels(make_docs):
    docs = make_docs([(1, "a b", None, None, 0), (2, "a b", "en", None, 0)])
    rows = mixing.mix_documents(docs, {m: 1.0 for m in mixing.MARGINS}, 1.0).collect()
    assert {(r["source"], r["lang"]) for r in rows} == {("(none)", "(none)"), ("(none)", "en")}


def test_kept_rows_are_the_drawn_ones(odd_docs, many):
    for docs in (odd_docs, many):
        drawn = sorted(str(r["doc_id"]) for r in mixing.mix_documents(docs, EXPONENTS, 0.4).collect())
        kept = mixing.keep_drawn(docs, EXPONENTS, 0.4)
        assert kept.columns == docs.columns and "Python" not in plan_of(kept)
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == drawn
