"""Row-quality rules, normalisation and derived columns on hand-made rows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windrow.functions import columns as fn
from windrow.operators import cleaning, features
from windrow.schemas import CARRIER, SILVER_COLUMNS

SETTINGS = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


BOUNDS = [
    ({}, True),
    ({"ArrDelay": -120.0}, True),
    ({"ArrDelay": 480.0}, True),
    ({"ArrDelay": -121.0}, False),
    ({"ArrDelay": 481.0}, False),
    ({"ArrDelay": None}, False),
    ({"DepDelay": -120.0}, True),
    ({"DepDelay": 480.5}, False),
    ({"DepDelay": None}, False),
    ({"Distance": 50.0, "AirTime": 30.0}, True),
    ({"Distance": 49.0, "AirTime": 20.0}, False),
    ({"Distance": 5000.0, "AirTime": 600.0}, True),
    ({"Distance": 5001.0, "AirTime": 600.0}, False),
    ({"Distance": 100.0, "AirTime": 60.0}, True),
    ({"Distance": 999.0, "AirTime": 60.0}, True),
    # 1000 / 60 * 60 is a little above 1000 in doubles, so the bound itself is out
    ({"Distance": 1000.0, "AirTime": 60.0}, False),
    ({"Distance": 99.0, "AirTime": 60.0}, False),
    ({"Distance": 1001.0, "AirTime": 60.0}, False),
    ({"AirTime": 0.0}, False),
    ({"AirTime": None}, False),
    ({"Cancelled": 1.0}, False),
    ({"Cancelled": None}, False),
]


def test_clean_bounds(flights):
    df = cleaning.clean(flights(*[change for change, _ in BOUNDS]))
    kept = {int(r["flight_id"], 16) for r in df.select("flight_id").collect()}
    assert kept == {i for i, (_, stays) in enumerate(BOUNDS) if stays}


def test_clean_without_optional_columns(flights):
    df = flights({}, {"ArrDelay": 900.0}).drop("AirTime", "Distance")
    assert cleaning.clean(df).count() == 1
    assert set(cleaning.quality_rules(df)) == {
        "not_cancelled", "critical_present", "arrival_delay", "departure_delay",
    }


ROW = st.fixed_dictionaries(
    {},
    optional={
        "ArrDelay": st.sampled_from([None, -121.0, 0.0, 16.0, 481.0]),
        "AirTime": st.sampled_from([None, 0.0, 20.0, 60.0]),
        "Cancelled": st.sampled_from([0.0, 1.0, None]),
        "Distance": st.sampled_from([49.0, 500.0, 6000.0]),
    },
)


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=30))
def test_clean_reports_account_for_every_row(flights, rows):
    df = flights(*rows)
    kept = cleaning.clean(df)
    assert cleaning.clean(kept).count() == kept.count()
    report = {r["outcome"]: r["row_count"] for r in cleaning.clean_report(df).collect()}
    assert sum(report.values()) == len(rows)
    assert report.get("kept", 0) == kept.count()
    steps = [r["rows_left"] for r in cleaning.clean_steps(df).orderBy("step").collect()]
    assert steps[0] == len(rows) and steps[-1] == kept.count()
    assert steps == sorted(steps, reverse=True)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("\taa ", "AA"), (" \u2003bb\u3000", "BB"), ("c\u00a0d\u0085", "C\u00a0D"), ("", ""),
        (" ", ""), ("\n\n", ""), ("\u00e9x", "\u00c9X"), (" x", "X"), ("x \t ", "X"), (None, None),
    ],
)
def test_codes_lose_all_white_space(flights, text, expected):
    row = cleaning.normalize_categories(flights({CARRIER: text, "Dest": text})).first()
    assert (row["AIRLINE"], row["Dest"], row["Origin"]) == (expected, expected, "JFK")
    assert row[CARRIER] == text


def test_derived_columns(flights):
    rows = [
        {"CRSDepTime": 5, "Month": 12, "ArrDelay": 0.0},
        {"CRSDepTime": 59, "Month": 3, "ArrDelay": 1.0},
        {"CRSDepTime": 100, "Month": 7, "ArrDelay": 15.0},
        {"CRSDepTime": 2359, "Month": 11, "ArrDelay": 16.0},
        {"CRSDepTime": 2400, "Month": None, "ArrDelay": 60.0},
        {"CRSDepTime": -5, "Month": 13, "ArrDelay": 61.0},
        {"CRSDepTime": None, "Month": 1, "ArrDelay": None, "Origin": None},
    ]
    out = cleaning.derive_features(flights(*rows)).orderBy("flight_id").collect()
    assert [r["DEP_HOUR"] for r in out] == [0, 0, 1, 23, 24, -1, None]
    assert [r["SEASON"] for r in out] == [
        "Winter", "Spring", "Summer", "Fall", "Unknown", "Unknown", "Winter",
    ]
    assert [r["DELAY_CATEGORY"] for r in out] == [
        "On Time", "Minor Delay", "Minor Delay", "Moderate Delay", "Moderate Delay",
        "Severe Delay", "Severe Delay",
    ]
    assert out[0]["ROUTE"] == "JFK-LAX" and out[-1]["ROUTE"] is None
    assert all(r["DAY_OF_WEEK"] == 5 for r in out)


def test_season_default_label(flights):
    months = flights({"Month": None}, {"Month": 9}, {"Month": 2})
    seasons = months.select(fn.season("Month", "Fall").alias("s")).orderBy("flight_id")
    assert sorted(r["s"] for r in seasons.collect()) == ["Fall", "Fall", "Winter"]


def test_date_parts_strict_and_lenient(spark):
    good = spark.createDataFrame([("2024-01-07",), ("2024-02-05",)], "FL_DATE string")
    rows = cleaning.date_parts(good).orderBy("FL_DATE").collect()
    assert [(r["DAY_OF_WEEK"], r["MONTH_NUM"]) for r in rows] == [(7, 1), (1, 2)]
    bad = spark.createDataFrame([("07.01.2024",)], "FL_DATE string")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        cleaning.date_parts(bad).collect()
    assert cleaning.date_parts(bad, lenient=True).first()["MONTH_NUM"] is None


def test_season_from_date(flights):
    df = flights({"Month": 1}).withColumn("FL_DATE", F.lit("2024-07-01"))
    row = cleaning.derive_features(df, from_date=True).first()
    assert (row["SEASON"], row["DAY_OF_WEEK"]) == ("Summer", 1)


def test_fill_nulls_by_declared_type(spark):
    schema = "i int, d double, s string, b boolean, t timestamp"
    df = spark.createDataFrame([(None,) * 5], schema)
    assert tuple(cleaning.fill_nulls_by_type(df).first()) == (0, 0.0, "", False, None)


def test_select_keeps_wanted_order(flights):
    got = cleaning.select_available(flights({})).columns
    assert got == [c for c in SILVER_COLUMNS if c in got]


def test_targets_are_strict(flights):
    df = features.features_full(flights({"ArrDelay": 15.0}, {"ArrDelay": 15.5}, {"ArrDelay": None}))
    rows = df.orderBy("flight_id").collect()
    assert [r["target_is_delayed"] for r in rows] == [0, 1]
    assert [r["target_arrival_delay"] for r in rows] == [15.0, 15.5]


def test_simple_features_sample_after_the_filter(flights):
    rows = [{"ArrDelay": None}] * 5 + [{"Distance": 0.0}] * 5 + [{}] * 4 + [{"Year": 2023}] * 3
    assert features.features_simple(flights(*rows), limit=3).count() == 3
    assert features.features_simple(flights(*rows), limit=10).count() == 4
    assert features.features_simple(flights(*rows), limit=None, year=None).count() == 7


def test_feature_summary(flights):
    table = features.features_full(flights({"ArrDelay": 0.0}, {"ArrDelay": 30.0}))
    assert tuple(features.feature_summary(table).first()) == (15.0, 0.5)
