"""Physical plans: what reaches the scan, and what must never appear."""

from __future__ import annotations

import re

import pytest

from windrow.operators import cleaning, features, kpis, reports, selection
from windrow.operators.maintenance import explain
from windrow.plans.queries import all_queries
from windrow.plans.silver import silver
from windrow.sources import fixture

#: Queries that write or train first; what they return is a plain scan or a local table.
EAGER = {
    "ml_regression", "ml_classification", "ml_metrics", "ml_scaled", "ml_onehot_width",
    "metric_auc", "table_stats", "csv_scan", "bronze_rows", "bronze_year_counts",
    "silver_roundtrip", "silver_upsert", "compact_rows", "schema_evolution",
}


def test_no_cross_join_or_python_in_any_query(spark, sf_dir):
    for name, query in all_queries().items():
        if name in EAGER:
            continue
        plan = explain(query(spark, sf_dir), "simple")
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
            assert bad not in plan, (name, bad)


def scan_of(df):
    plan = explain(df)
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    return plan, {c.split(":")[0] for c in schema.split(",")}


@pytest.fixture
def bronze(spark, sf_dir):
    return fixture.bronze(spark, sf_dir)


def test_silver_pushes_ranges_and_year(bronze):
    plan, _ = scan_of(silver(cleaning.filter_year(bronze, 2023)))
    assert "GreaterThanOrEqual(ArrDelay,-120.0)" in plan
    assert re.search(r"PartitionFilters: \[.*Year#\d+ = 2023", plan)
    assert "Exchange" not in plan


def test_temporal_kpis_read_only_their_columns(bronze):
    plan, columns = scan_of(kpis.temporal_kpis(silver(bronze)))
    assert columns == {
        "Month", "DayOfWeek", "CRSDepTime", "DepDelay", "ArrDelay", "Cancelled", "Distance",
        "AirTime",
    }


def test_top_k_does_not_sort_everything(bronze):
    plan, _ = scan_of(reports.carrier_month_topk(silver(bronze), 2023, ["BRAND#1"]))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_ranked_kpis_combine_before_each_shuffle(bronze):
    plan = explain(kpis.airport_kpis(silver(bronze)).orderBy("Origin"), "simple")
    assert plan.count("hashpartitioning") == 2
    assert re.search(r"Exchange hashpartitioning\(Origin#\d+, Year#\d+, Month#\d+, ArrDelay", plan)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_route_kpis_hash_aggregate(bronze):
    plan = explain(kpis.route_kpis(silver(bronze)), "simple")
    assert "SortAggregate" not in plan and plan.count("hashpartitioning") == 1


def test_stratified_split_does_not_move_the_rows(bronze):
    rows = features.features_full(silver(bronze))
    split = selection.split_stratified(rows, "target_is_delayed")
    split.count()
    # The run-time plan: the cut-offs, one row for each class, are broadcast to the rows.
    plan = split._jdf.queryExecution().executedPlan()
    split.write.format("noop").mode("overwrite").save()
    assert "Python" not in plan.toString() and "CartesianProduct" not in plan.toString()


def test_describe_sorts_no_table_in_one_task(bronze):
    rows = features.features_full(silver(bronze))
    plan = explain(reports.describe_column(rows, "target_arrival_delay"), "simple")
    assert plan.count("SinglePartition") == 1 and "Sort" not in plan.split("SinglePartition")[0]
