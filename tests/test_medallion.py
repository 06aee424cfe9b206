"""The layers end to end, from CSV to models and maintenance."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from windrow.operators import features, kpis, maintenance
from windrow.plans import gold, medallion
from windrow.plans.queries import _raw
from windrow.plans.silver import silver
from windrow.schemas import RAW
from windrow.sources import ingest, snapshots


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    csv = str(root / "source")
    ingest.write_csv(_raw(spark, sf_dir).select(*RAW.names), csv)
    return medallion.Medallion(str(root / "tables"), csv, trees=3, depth=3)


@pytest.fixture(scope="module")
def reports(spark, lake):
    return medallion.run_layers(spark, lake)


def test_all_layers_run_in_order(reports):
    assert list(reports) == list(medallion.LAYERS)
    assert not [r for r in reports.values() if isinstance(r, Exception)]


def test_layers_hold_what_the_plans_say(spark, sf_dir, lake, reports):
    raw = _raw(spark, sf_dir)
    assert snapshots.read(spark, lake.bronze).count() == raw.count()
    rows = snapshots.read(spark, lake.silver)
    assert rows.count() == silver(raw).count()
    assert rows.where("ingested_at IS NULL OR flight_id IS NULL").count() == 0
    airports = snapshots.read(spark, f"{lake.analytics}/airport_analytics")
    expected = kpis.airport_kpis(silver(raw))
    assert {tuple(r) for r in airports.select(*expected.columns).collect()} == {
        tuple(r) for r in expected.collect()
    }
    table = snapshots.read(spark, lake.features)
    assert table.agg(F.sum("target_is_delayed")).first() == features.features_full(
        silver(raw)
    ).agg(F.sum("target_is_delayed")).first()


def test_reports(spark, lake, reports):
    years = {r["Year"]: r["status"] for r in reports["bronze"].collect()}
    assert set(years.values()) == {"written"} and len(years) == 7
    gold_rows = {r["table_name"]: r["error"] for r in reports["gold"].collect()}
    assert len(gold_rows) == 5 and set(gold_rows.values()) == {None}
    assert reports["ml"].count() == 10
    summary = {r["table_name"]: r for r in medallion.summary_report(spark, lake).collect()}
    assert summary["silver"]["version"] == 1 and summary["silver"]["row_count"] == 4888
    runs = spark.read.parquet(f"{lake.runs}/runs").collect()
    assert len(runs) == 4 and all(r["feature_version"] == 0 for r in runs)


def test_second_run_changes_no_rows(spark, lake, reports):
    before = snapshots.read(spark, lake.silver).count()
    reports = medallion.run_layers(spark, lake, ["bronze", "silver"])
    assert not [r for r in reports.values() if isinstance(r, Exception)]
    assert snapshots.read(spark, lake.bronze).count() == 6000
    assert snapshots.read(spark, lake.silver).count() == before


def test_single_layer_and_unknown_layer(spark, lake, reports):
    assert medallion.run(spark, lake, "BRONZE") is True
    assert medallion.run(spark, lake, "platinum") is False


def test_first_failure_ends_the_run(spark, tmp_path):
    broken = medallion.Medallion(str(tmp_path), str(tmp_path / "missing.csv"))
    assert medallion.run(spark, broken) is False
    assert list(medallion.run_layers(spark, broken)) == ["bronze"]


def test_a_failing_gold_table_does_not_stop_the_others(spark, tmp_path, flights):
    good = kpis.kpi(flights({}), ["Year", "Month"], ["total_flights"])
    bad = good.withColumn("x", F.raise_error(F.lit("no")).cast("int"))
    outcome = gold.write_tables({"bad": bad, "good": good}, str(tmp_path))
    assert outcome["good"] is None and "no" in outcome["bad"]
    assert snapshots.read(spark, str(tmp_path / "good")).count() == 1


def test_simple_tables_go_to_csv(spark, tmp_path, sf_dir):
    raw = _raw(spark, sf_dir).where("Year = 2024")
    tables = gold.simple_tables(raw, 1, 1, 1, sample=50)
    gold.write_csv_tables(tables, str(tmp_path))
    for name, table in tables.items():
        back = ingest.read_csv(spark, str(tmp_path / name), schema=table.schema)
        assert back.columns == table.columns
        assert {tuple(r) for r in back.collect()} == {tuple(r) for r in table.collect()}


def test_explain_names_the_scan(spark, lake, reports):
    plan = maintenance.explain(silver(snapshots.read(spark, lake.bronze)))
    assert "PushedFilters" in plan and "EqualTo(Cancelled,0.0)" in plan


def test_run_is_false_when_a_gold_table_fails(spark, lake, reports, monkeypatch):
    whole = gold.gold_tables

    def broken(silver_rows):
        tables = whole(silver_rows)
        bad = tables["airport_analytics"].withColumn("x", F.raise_error(F.lit("no")).cast("int"))
        return {**tables, "airport_analytics": bad}

    monkeypatch.setattr(gold, "gold_tables", broken)
    assert medallion.run(spark, lake, "gold") is False
    error = medallion.run_layers(spark, lake, ["gold"])["gold"]
    assert isinstance(error, medallion.TablesFailed) and set(error.failed) == {"airport_analytics"}


def test_gold_without_silver_and_the_simple_path(spark, lake, reports, tmp_path):
    bare = medallion.Medallion(str(tmp_path / "bare"), lake.source_csv, trees=2, depth=2)
    assert medallion.run(spark, bare, "gold") is True
    rows = snapshots.read(spark, bare.features).count()
    assert rows == snapshots.read(spark, lake.features).count()
    sizes = {r["table_name"]: r["row_count"] for r in medallion.run_simple(spark, bare).collect()}
    assert set(sizes) == {"airport_analytics", "airline_analytics", "temporal_analytics", "features"}
    assert sizes["features"] > 0
