"""KPI tables against brute force, also where one group holds most of the rows."""

from __future__ import annotations

import hashlib
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from windrow.operators import kpis, reports
from windrow.operators.cleaning import derive_features
from windrow.schemas import CARRIER

SETTINGS = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
MEASURES = [
    "total_flights", "avg_arrival_delay", "median_arrival_delay", "p95_arrival_delay",
    "delayed_flights", "delay_rate",
]


def brute(delays: list) -> tuple:
    known = sorted(d for d in delays if d is not None)
    late = sum(d > 15 for d in known)
    if not known:
        return (len(delays), None, None, None, 0, None)
    # round half up, as ranks are never negative
    rank = int((len(known) - 1) * 0.95 + 0.5)
    return (
        len(delays), sum(known) / len(known), statistics.median(known), known[rank],
        late, late / len(known),
    )


def test_nearest_quantile_and_median(flights):
    df = flights(*[{"ArrDelay": float(i)} for i in range(1, 21)])
    row = kpis.kpi(df, ["Origin"], ["median_arrival_delay", "p95_arrival_delay"]).first()
    assert (row["median_arrival_delay"], row["p95_arrival_delay"]) == (10.5, 19.0)


DELAYS = st.lists(
    st.one_of(st.none(), st.integers(-20, 60).map(float)), min_size=1, max_size=40
)


@SETTINGS
@given(st.dictionaries(st.sampled_from(["A", "B", "C"]), DELAYS, min_size=1))
def test_ranked_measures_match_brute_force(flights, groups):
    df = flights(*[{"Origin": o, "ArrDelay": d} for o, ds in groups.items() for d in ds])
    got = {r[0]: tuple(r)[1:] for r in kpis.kpi(df, ["Origin"], MEASURES).collect()}
    assert got == {origin: brute(delays) for origin, delays in groups.items()}


def test_hot_group_matches_brute_force(spark, flights):
    random.seed(7)
    rows = [{"Origin": "HUB", "ArrDelay": float(random.randint(-30, 90))} for _ in range(3000)]
    rows += [
        {"Origin": f"X{random.randint(0, 99)}", "ArrDelay": float(random.randint(-30, 90))}
        for _ in range(1500)
    ]
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(row["Origin"], []).append(row["ArrDelay"])
    got = {r[0]: tuple(r)[1:] for r in kpis.kpi(flights(*rows), ["Origin"], MEASURES).collect()}
    assert got == {origin: brute(delays) for origin, delays in groups.items()}


def test_group_without_known_delays(flights):
    df = flights({"ArrDelay": None}, {"ArrDelay": None, "Distance": None})
    row = kpis.kpi(df, ["Origin"], kpis.AIRPORT).first()
    assert row["total_flights"] == 2 and row["delayed_flights"] == 0
    assert row["delay_rate"] is None and row["p95_arrival_delay"] is None
    assert row["avg_distance"] == 500.0


def test_null_key_is_a_group(flights):
    df = flights({"Origin": None}, {"Origin": None}, {})
    got = {r["Origin"]: r["total_flights"] for r in kpis.kpi(df, ["Origin"], MEASURES).collect()}
    assert got == {None: 2, "JFK": 1}


def test_unique_routes_count_null_once(flights):
    df = derive_features(
        flights({}, {"ArrDelay": 9.0}, {"Dest": None}, {"Dest": None, "ArrDelay": None})
    ).withColumnRenamed(CARRIER, "AIRLINE")
    row = kpis.airline_kpis(df).first()
    assert row["unique_routes"] == 2 and row["total_flights"] == 4
    assert row["avg_arrival_delay"] == (7.0 + 9.0 + 7.0) / 3


def test_distance_is_that_of_the_key_of_lowest_hash(flights):
    rows = [
        {"flight_id": f"{key:032x}", "Distance": float(key)}
        for key in (0xF << 120, 0x2 << 120, 0x9 << 120)
    ]
    df = derive_features(flights(*rows))
    row = kpis.route_kpis(df, min_flights=3).first()
    lowest = min(rows, key=lambda r: hashlib.md5(r["flight_id"].encode()).hexdigest())
    assert row["distance"] == lowest["Distance"]
    assert kpis.route_kpis(df, min_flights=4).count() == 0
    assert kpis.route_kpis(df.drop("flight_id"), 1).first()["distance"] == float(0x2 << 120)


def test_limits_and_order_of_simple_tables(flights):
    rows = [{"Origin": o, "Month": m} for o, m, n in
            [("A", 1, 3), ("B", 1, 5), ("C", 1, 1), ("A", 2, 4)] for _ in range(n)]
    table = kpis.airport_kpis_simple(flights(*rows), min_flights=3).collect()
    assert [(r["Month"], r["Origin"]) for r in table] == [(1, "B"), (1, "A"), (2, "A")]
    hours = kpis.temporal_kpis_simple(flights(*rows), min_flights=5).collect()
    assert [(r["Month"], r["DEP_HOUR"], r["total_flights"]) for r in hours] == [(1, 9, 9)]


def test_totals_over_any_key_equal_the_rows(flights):
    df = derive_features(flights(*[{"Month": m % 12 + 1, "CRSDepTime": m * 7 % 2400}
                                   for m in range(60)]))
    for keys in (["Month"], ["DEP_HOUR"], ["SEASON", "Origin"]):
        table = kpis.kpi(df, keys, ["total_flights", "delayed_flights"]).collect()
        assert sum(r["total_flights"] for r in table) == 60
        assert all(r["delayed_flights"] <= r["total_flights"] for r in table)


def test_describe_column(flights):
    values = [3.0, None, 1.0, 2.0, 10.0, 2.0]
    df = flights(*[{"ArrDelay": v} for v in values])
    row = reports.describe_column(df, "ArrDelay").first()
    known = sorted(v for v in values if v is not None)
    assert (row["count"], row["null_count"], row["min"], row["max"]) == (5, 1, 1.0, 10.0)
    assert row["mean"] == pytest.approx(statistics.mean(known), abs=1e-6)
    assert row["std"] == pytest.approx(statistics.stdev(known), abs=1e-6)
    assert (row["q25"], row["q50"], row["q75"]) == (2.0, 2.0, 3.0)


def test_worst_best_takes_a_null_average_first(spark):
    schema = "Origin string, Month int, avg_arrival_delay double"
    table = spark.createDataFrame([("A", 1, 5.0), ("B", 1, 9.0), ("B", 2, 1.0)], schema)
    got = {r["rank"]: (r["entity"], r["Month"]) for r in
           reports.worst_best(table, "Origin").collect()}
    assert got == {"worst": ("B", 1), "best": ("B", 2)}
    unknown = table.union(spark.createDataFrame([("C", 3, None)], schema))
    got = {r["rank"]: r["entity"] for r in reports.worst_best(unknown, "Origin").collect()}
    assert got == {"worst": "C", "best": "C"}


def test_worst_hours_columns_and_order(flights):
    rows = [{"CRSDepTime": h * 100, "ArrDelay": float(h)} for h in range(10) for _ in range(2)]
    table = kpis.temporal_kpis_simple(flights(*rows), min_flights=2)
    worst = reports.worst_hours(table, ["Month", "DayOfWeek", "DEP_HOUR"], k=3).collect()
    assert [r["DEP_HOUR"] for r in worst] == [9, 8, 7]
