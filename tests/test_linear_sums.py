"""What a linear fit adds up, by the tasks that read the rows."""

from __future__ import annotations

import numpy as np
import pytest

from windrow.operators import linear

ROWS = [
    (1.0, 2.0, "a", "p", 3.0), (2.0, -1.0, "b", "p", 1.0), (4.0, 0.5, None, "q", 2.0),
    (3.0, 1.0, "a", None, 5.0), (3.0, 1.0, "a", None, 5.0), (0.0, 7.0, "b", "q", -4.0),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "x double, z double, c string, d string, y double").repartition(3)


def test_products_are_those_of_the_dense_design(rows):
    found = linear._Rows(rows, ["x", "z"], ["c", "d"], "y", 100)
    products, (targets,) = found.products(found.df.withColumn("_w", found.df["_x0"] + 3), "_w", "_y")
    columns = [np.array([r[i] for r in ROWS]) for i in (0, 1)]
    x = [(c - c.mean()) / c.std() for c in columns]
    ones = [[float(r[i] == v) for r in ROWS] for i, v in ((2, "a"), (2, "b"), (3, "p"), (3, "q"))]
    dense = np.array([*x, *ones, np.ones(len(ROWS))]).T
    assert products == pytest.approx(dense.T @ (dense * (x[0] + 3)[:, None]))
    assert targets == pytest.approx(dense.T @ np.array([r[4] for r in ROWS]))


def test_rows_are_not_multiplied(spark, rows, monkeypatch):
    design = linear.Design([("x", 1.0, 2.0)], {"c": ["a", "b"]})
    sums = linear.column_sums(rows, design, "y")
    plans = [sums._jdf.queryExecution().toString()]
    kept = type(sums).toArrow
    monkeypatch.setattr(type(sums), "toArrow", lambda df: plans.append(df._jdf.queryExecution().toString()) or kept(df))
    linear.least_squares(rows.dropna(), ["x"], ["c"], "y")
    assert len(plans) > 1 and not any("Generate" in p for p in plans)
    expected = {
        (linear.INTERCEPT, None): (6, 12.0), ("x", None): (6, sum((r[0] - 1) / 2 * r[4] for r in ROWS)),
        ("c", "a"): (3, 13.0), ("c", "b"): (2, -3.0), ("c", None): (1, 2.0),
    }
    assert {(r["feature"], r["value"]): (r["row_count"], r["total"]) for r in sums.collect()} == expected
