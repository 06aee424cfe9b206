"""Radix selection against sorting."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from windrow.operators import kpis
from windrow.operators.quantiles import group_quantiles, order_key, order_value

QUANTILES = {"median": (0.5, "median"), "p95": (0.95, "nearest"), "low": (0.0, "nearest"), "high": (1.0, "nearest")}
ODD = [0.0, -0.0, 1.5, -1.5, 1e-320, -1e-320, 1e308, -1e308, math.inf, -math.inf, 0.1, 0.1 + 2**-56, 3.0, -7.25]


def rank(share: float, n: int) -> int:
    place = (n - 1) * share
    return math.floor(place + 0.5)


def plain(values):
    have = sorted(v for v in values if v is not None)
    if not have:
        return (None,) * 4
    place = (len(have) - 1) * 0.5
    low, high = have[math.floor(place)], have[math.ceil(place)]
    median = low if low == high else (low + high) / 2
    return (median, *(have[rank(q, len(have))] for q in (0.95, 0.0, 1.0)))


def test_keys_keep_the_order_and_the_value(spark):
    made = random.Random(2)
    values = ODD + [made.uniform(-1, 1) * 10 ** made.randint(-300, 300) for _ in range(500)] + [math.nan, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", order_key("v").alias("k"), order_value(order_key("v")).alias("b")
    ).collect()
    known = [r for r in rows if r["v"] is not None]
    assert [r["k"] for r in rows if r["v"] is None] == [None]
    ordered = sorted((r for r in known if not math.isnan(r["v"])), key=lambda r: r["k"])
    assert [r["v"] for r in ordered] == sorted(r["v"] for r in known if not math.isnan(r["v"]))
    assert all(r["b"] == r["v"] or math.isnan(r["v"]) for r in known)
    assert max(known, key=lambda r: r["k"])["v"] != max(known, key=lambda r: r["k"])["v"]
    zeros = {r["k"] for r in known if r["v"] == 0}
    assert len(zeros) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_sorting(spark, seed):
    made = random.Random(seed)
    rows = [("hot", 1, made.gauss(0, 50)) for _ in range(4000)]
    rows += [(made.choice(["a", "b", None]), made.choice([1, 2, None]), made.choice([*ODD, None])) for _ in range(300)]
    rows += [("none", 1, None), ("one", 1, 4.25), ("two", 2, -1.0), ("two", 2, 2.0)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(7)
    found = group_quantiles(df, ["g", "h"], "v", QUANTILES).collect()
    groups = {}
    for g, h, v in rows:
        groups.setdefault((g, h), []).append(v)
    assert {(r["g"], r["h"]): tuple(r)[2:] for r in found} == {k: plain(v) for k, v in groups.items()}
    assert group_quantiles(df.limit(0), ["g"], "v", QUANTILES).count() == 0


def test_a_hot_group_is_spread_over_tasks(spark):
    """Half of the rows belong to one group, and all values differ."""
    n = 200_000
    df = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        ((F.col("id") * 7919) % n / F.lit(3.0) - 20_000).alias("v"),
    )
    keyed = df.select("g", order_key("v").alias("_key")).groupBy("g", "_key").agg(F.count("*").alias("_n"))
    sizes = keyed.repartition(8, "g", "_key").groupBy(F.spark_partition_id().alias("p")).count().collect()
    counts = sorted(r["count"] for r in sizes)
    assert len(counts) == 8 and counts[-1] <= 2 * counts[4]
    found = {r["g"]: r["median"] for r in group_quantiles(df, ["g"], "v", QUANTILES).collect()}
    exact = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.expr("percentile(v, 0.5)").alias("m")).collect()}
    assert found == pytest.approx(exact)


def test_kpis_over_any_delays_equal_those_over_counts(flights):
    made = random.Random(4)
    rows = [{"Origin": made.choice("AB"), "Month": made.choice([1, 2]), "ArrDelay": made.choice([None, 1.0, 7.0, 12.5])} for _ in range(200)]
    df = flights(*rows)
    counted = kpis.kpi(df, ["Origin", "Month"], kpis.AIRPORT, min_flights=20)
    chosen = kpis.kpi(df, ["Origin", "Month"], kpis.AIRPORT, min_flights=20, fractional=True)
    assert chosen.columns == counted.columns
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, counted.collect()))
    routes = kpis.kpi(df.withColumn("ROUTE", F.col("Origin")), ["Month"], ["total_flights", "median_arrival_delay", "unique_routes"], fractional=True)
    assert [r["unique_routes"] for r in routes.collect()] == [2, 2]
