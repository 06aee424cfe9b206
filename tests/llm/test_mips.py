from __future__ import annotations

import math
import random

import pytest

from windrow.llm import mips


def brute(rows, divisor, k):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    out = []
    for q, v in vectors:
        if q % divisor:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, v int, score int")


@pytest.mark.parametrize("bucket_rows, query_rows", [(7, 3), (4096, 2048)])
def test_against_brute_force(spark, monkeypatch, bucket_rows, query_rows):
    monkeypatch.setattr(mips, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(mips, "QUERY_ROWS", query_rows)
    some = random.Random(0)
    rows = [(i, [some.gauss(0, 1) * (1 + i % 5) for _ in range(6)]) for i in range(60)]
    rows += [(60 + i, rows[3][1]) for i in range(25)]  # ties
    rows += [(100, [0.0] * 6), (101, [-1.0] * 6)]
    full = [(i, v, 0, 1, 2) for i, v in rows]
    odd = [(200, None, 0, 1, 2), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, 1, 2), (220, [float("nan")] + [0.0] * 5, 0, 1, 2), (240, [float("inf")] + [0.0] * 5, 0, 1, 2), (None, [9.0] * 6, 0, 1, 2)]
    table = vectors(spark, full + odd)
    found = mips.exact_top_k(mips.integer_vectors(table), "vec_id % 4 = 0", k=20)
    exact = [(i, [float(x) for x in v]) for i, v in ((r[0], r[1]) for r in vectors(spark, full).select("vec_id", "embedding").collect())]
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == brute(exact, 4, 20)


def test_few_rows_and_none(spark):
    table = vectors(spark, [(0, [1.0, 2.0], 0, 0, 0), (1, [0.5, 0.5], 0, 0, 0), (0, [1.0, 2.0], 0, 0, 0)])
    rows = mips.exact_top_k(mips.integer_vectors(table), "vec_id % 20 = 0", k=20).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(0, 1, 1)]
    assert mips.exact_top_k(mips.integer_vectors(table.limit(0)), "vec_id % 20 = 0").count() == 0
    assert mips.exact_top_k(mips.integer_vectors(table.where("vec_id = 1")), "vec_id % 20 = 0").count() == 0
