"""The layers in order: bronze, silver, gold, models, maintenance."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from windrow.functions.columns import hour_of
from windrow.operators import maintenance, models, reports
from windrow.operators.cleaning import filter_year
from windrow.operators.features import features_full
from windrow.operators.selection import with_flight_id
from windrow.plans import gold
from windrow.plans.silver import silver
from windrow.schemas import RAW
from windrow.sources import ingest, snapshots

log = logging.getLogger(__name__)

LAYERS = ("bronze", "silver", "gold", "ml", "maintenance")

#: Columns each table is clustered by; tables not named here are compacted.
CLUSTER_COLUMNS = {
    "silver": ["AIRLINE", "Origin", "Dest"],
    "features": ["AIRLINE", "Origin", "Dest"],
}


class TablesFailed(RuntimeError):
    """Some tables of a layer could not be written; the others were."""

    def __init__(self, failed: dict[str, str]):
        super().__init__(f"tables that failed: {failed}")
        self.failed = failed


@dataclass(frozen=True)
class Medallion:
    """Where the layers live and how they are built."""

    root: str
    source_csv: str
    #: Years to ingest; None takes all years of the source.
    years: Sequence[int] | None = None
    fill_nulls: bool = False
    trees: int = 100
    depth: int = 5
    #: Year of the smaller path; None takes all.
    simple_year: int | None = 2024
    #: Columns that identify a source row; ``flight_id`` is hashed from them where absent.
    row_key: Sequence[str] = tuple(RAW.names)

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/flights"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/flights_clean"

    @property
    def analytics(self) -> str:
        return f"{self.root}/gold/analytics"

    @property
    def features(self) -> str:
        return f"{self.root}/gold/features"

    @property
    def runs(self) -> str:
        return f"{self.root}/ml"

    def tables(self) -> dict[str, str]:
        names = ["airport_analytics", "airline_analytics", "temporal_analytics", "route_analytics"]
        return {
            "bronze": self.bronze,
            "silver": self.silver,
            **{name: f"{self.analytics}/{name}" for name in names},
            "features": self.features,
        }


def run_bronze(spark: SparkSession, lake: Medallion) -> DataFrame:
    source = ingest.read_csv(spark, lake.source_csv)
    if "flight_id" not in source.columns:
        source = with_flight_id(source, [c for c in lake.row_key if c in source.columns])
    rows = ingest.with_ingest_metadata(source)
    report = ingest.ingest_years(rows, lake.bronze, lake.years, lake.fill_nulls)
    failed = {str(r["Year"]): "failed" for r in report.where("status = 'failed'").collect()}
    if failed:
        raise TablesFailed(failed)
    return report


def run_silver(spark: SparkSession, lake: Medallion) -> DataFrame:
    rows = silver(snapshots.read(spark, lake.bronze))
    log.info("silver plan\n%s", maintenance.explain(rows))
    snapshots.merge_with_existing(rows, lake.silver, partition_by=gold.PARTITIONS)
    return maintenance.tables_stats(spark, {"silver": lake.silver})


def _silver_rows(spark: SparkSession, lake: Medallion) -> DataFrame:
    """The silver table, or the raw CSV cleaned on the way where there is none."""
    if snapshots.commits(spark, lake.silver):
        return snapshots.read(spark, lake.silver)
    raw = ingest.read_csv(spark, lake.source_csv)
    if "flight_id" not in raw.columns:
        raw = with_flight_id(raw, [c for c in lake.row_key if c in raw.columns])
    return silver(ingest.with_ingest_metadata(raw))


def run_simple(spark: SparkSession, lake: Medallion) -> DataFrame:
    """The smaller path: one year of bronze (or of the raw CSV) to CSV tables and models."""
    raw = ingest.table_or_csv(spark, lake.bronze, lake.source_csv, lake.simple_year)
    raw = raw if lake.simple_year is None else filter_year(raw, lake.simple_year)
    if "flight_id" not in raw.columns:
        raw = with_flight_id(raw, [c for c in lake.row_key if c in raw.columns])
    if "DEP_HOUR" not in raw.columns:
        raw = raw.withColumn("DEP_HOUR", hour_of("CRSDepTime"))
    tables = gold.simple_tables(raw)
    gold.write_csv_tables(tables, f"{lake.root}/simple")
    prepared = models.prepare(tables["features"], models.SIMPLE)
    trained = [
        *models.train_regression(prepared, models.SIMPLE, trees=lake.trees, depth=lake.depth),
        *models.train_classification(prepared, models.SIMPLE, trees=lake.trees, depth=lake.depth),
    ]
    models.log_runs(spark, trained, f"{lake.root}/simple/ml")
    return reports.result_sizes(tables)


def run_gold(spark: SparkSession, lake: Medallion) -> DataFrame:
    """Every table reads the written silver table, each with its own columns only."""
    rows = _silver_rows(spark, lake)
    outcome = gold.write_tables(gold.gold_tables(rows), lake.analytics)
    gold.write_features(rows, lake.features)
    failed = {name: error for name, error in outcome.items() if error}
    if failed:
        raise TablesFailed(failed)
    tables = {k: v for k, v in lake.tables().items() if k not in ("bronze", "silver")}
    return maintenance.tables_stats(spark, tables)


def run_ml(spark: SparkSession, lake: Medallion) -> DataFrame:
    version = snapshots.current_version(spark, lake.features)
    if version is None:
        features = features_full(_silver_rows(spark, lake))
    else:
        features = snapshots.read(spark, lake.features)
    prepared = models.prepare(features)
    trained = [
        *models.train_regression(prepared, trees=lake.trees, depth=lake.depth),
        *models.train_classification(prepared, trees=lake.trees, depth=lake.depth),
    ]
    models.log_runs(spark, trained, lake.runs, version, save_models=True)
    return models.metrics_table(spark, trained)


def run_maintenance(spark: SparkSession, lake: Medallion) -> DataFrame:
    done = maintenance.optimize_tables(spark, lake.tables(), CLUSTER_COLUMNS)
    if len(snapshots.commits(spark, lake.silver)) > 1:
        newest_two = maintenance.compare_versions(spark, lake.silver).collect()
        log.info("silver rows by version: %s", {r["version"]: r["row_count"] for r in newest_two})
    cleaned = [lake.bronze, lake.silver, lake.features]
    vacuumed = maintenance.vacuum_tables(spark, {p.rsplit("/", 1)[1]: p for p in cleaned})
    failed = {
        r["table_name"]: r["error"]
        for r in [*done.collect(), *vacuumed.collect()] if r["error"] is not None
    }
    if failed:
        raise TablesFailed(failed)
    return done


RUNNERS = {
    "bronze": run_bronze,
    "silver": run_silver,
    "gold": run_gold,
    "simple": run_simple,
    "ml": run_ml,
    "maintenance": run_maintenance,
}


def run_layers(
    spark: SparkSession, lake: Medallion, layers: Sequence[str] = LAYERS
) -> dict[str, DataFrame | Exception]:
    """Runs the layers in order and returns each one's report.

    The first failing layer is reported with its error and ends the run.
    """
    reports: dict[str, DataFrame | Exception] = {}
    for layer in layers:
        try:
            reports[layer] = RUNNERS[layer](spark, lake)
        except Exception as error:
            log.exception("layer %s failed", layer)
            reports[layer] = error
            break
    return reports


def run(spark: SparkSession, lake: Medallion, layer: str | None = None) -> bool:
    """Runs one layer, or all of them; true when nothing failed. Unknown layers are refused."""
    layers = LAYERS if layer is None else (layer.lower(),)
    if not set(layers) <= set(RUNNERS):
        log.error("unknown layer: %s", layer)
        return False
    reports = run_layers(spark, lake, layers)
    return len(reports) == len(layers) and not any(
        isinstance(r, Exception) for r in reports.values()
    )


def summary_report(spark: SparkSession, lake: Medallion) -> DataFrame:
    """Version, files, bytes and rows of every table."""
    return maintenance.tables_stats(spark, lake.tables())
