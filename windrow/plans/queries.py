"""One registered query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators import (
    cleaning, features, importance, kpis, linear, maintenance, metrics, models, packing, reports,
    selection, zorder,
)
from windrow.operators.categories import dictionary
from windrow.plans import gold
from windrow.plans.medallion import Medallion, run_layers
from windrow.plans.silver import silver
from windrow.schemas import CARRIER, DEFAULT_YEARS, FLIGHTS, SILVER_COLUMNS
from windrow.session import scratch_path, written_once
from windrow.sources import fixture, ingest, snapshots

Query = Callable[[SparkSession, str], DataFrame]

#: Group-size limits of the simple tables, smaller than the defaults as the fixture is small.
MIN_AIRPORT, MIN_AIRLINE, MIN_TEMPORAL = 20, 20, 5
CARRIERS = ["BRAND#1", "BRAND#2", "BRAND#3"]
FIRST_COMMIT = datetime(2024, 1, 1)

#: Columns of different types, from seven values to one for each row.
Z_COLUMNS = [
    "Year", "Month", "DayofMonth", "AIRLINE", "Origin", "Dest", "DEP_HOUR", "DepDelay", "Distance", "flight_id",
]

_queries: dict[str, Query] = {}
_histories: dict[tuple[str, str], str] = {}


def query(run: Query) -> Query:
    _queries[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze(spark, sf_dir).drop("FL_DATE")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze(spark, sf_dir).select(*FLIGHTS.names)


def _raw_with_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze(spark, sf_dir).select(*FLIGHTS.names, "FL_DATE")


def _raw_2024(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.filter_year(_raw(spark, sf_dir), 2024)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(_bronze(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.features_full(_silver(spark, sf_dir))


def _commit_time(version: int) -> datetime:
    return FIRST_COMMIT + timedelta(days=version)


def history_table(spark: SparkSession, sf_dir: str) -> str:
    """Path of a bronze table with a history, written once per session.

    Versions 0-6 append one ship year each, 7 compacts, 8 upserts: flights of January 2024
    get a new departure delay and those of the fixture's year 2018 come again under a new key.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _histories:
        table = scratch_path(spark, "history")
        rows = _bronze(spark, sf_dir)
        for version, year in enumerate(DEFAULT_YEARS):
            batch = cleaning.filter_year(rows, year)
            snapshots.commit(batch, table, ["Year"], "append", _commit_time(version), layout=False)
        maintenance.compact(spark, table, committed_at=_commit_time(7), everything=True)
        snapshots.upsert(
            _changes(rows), table, ["Year", "flight_id"], ["Year"], _commit_time(8)
        )
        _histories[key] = table
    return _histories[key]


def _changes(rows: DataFrame) -> DataFrame:
    changed = rows.where((F.col("Year") == 2024) & (F.col("Month") == 1))
    again = rows.where((F.col("Year") == 2018) & (F.col("Month") == 1))
    return changed.withColumn("DepDelay", F.lit(1.0)).unionByName(
        again.withColumn("flight_id", F.concat("flight_id", F.lit("-2")))
    )


# --- Sources and sinks


@query
def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw records as derived from the given tables, before any layer."""
    return fixture.flights(spark, sf_dir, with_date=True)


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    ingest.write_csv(_raw(spark, sf_dir), path)
    return ingest.read_csv(spark, path)


@query
def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_path(spark, "bronze")
    ingest.ingest_years(_bronze(spark, sf_dir), table, DEFAULT_YEARS, committed_at=FIRST_COMMIT)
    return snapshots.read(spark, table).drop(*snapshots.VERSION_COLUMNS)


@query
def bronze_year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_path(spark, "bronze")
    years = [*DEFAULT_YEARS, 2030]
    return ingest.ingest_years(_bronze(spark, sf_dir), table, years)


@query
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_path(spark, "silver")
    snapshots.merge_with_existing(_silver(spark, sf_dir), table, partition_by=gold.PARTITIONS)
    return cleaning.select_available(snapshots.read(spark, table))


@query
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_path(spark, "silver")
    rows = _silver(spark, sf_dir)
    keys = ["Year", "Month", "flight_id"]
    snapshots.merge_with_existing(rows, table, keys, gold.PARTITIONS)
    snapshots.merge_with_existing(_changes(rows), table, keys, gold.PARTITIONS)
    return cleaning.select_available(snapshots.read(spark, table))


@query
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.read(spark, history_table(spark, sf_dir)).drop(*snapshots.VERSION_COLUMNS)


@query
def as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots.time_travel(spark, history_table(spark, sf_dir), version=3)
    return rows.drop("_operation")


@query
def as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots.time_travel(
        spark, history_table(spark, sf_dir), timestamp=datetime(2024, 1, 2, 12)
    )
    return rows.drop("_operation")


# --- Silver


@query
def filter_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.filter_year(_raw(spark, sf_dir), 2023)


@query
def clean_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_steps(_raw(spark, sf_dir))


@query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(_raw(spark, sf_dir))


@query
def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_report(_raw(spark, sf_dir))


@query
def fill_nulls_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_nulls_by_type(_raw(spark, sf_dir))


@query
def normalize_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.normalize_categories(_raw(spark, sf_dir))
    return rows.select("flight_id", CARRIER, "AIRLINE", "Origin", "Dest")


@query
def derive_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.derive_features(_raw(spark, sf_dir))
    return rows.select(
        "flight_id", "DEP_HOUR", "DAY_OF_WEEK", "SEASON", "ROUTE", "DELAY_CATEGORY"
    )


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_with_date(spark, sf_dir)
    parts = cleaning.derive_features(rows, from_date=True)
    return parts.select("flight_id", "FL_DATE", "DAY_OF_WEEK", "MONTH_NUM", "SEASON")


@query
def silver_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.select_available(_raw(spark, sf_dir), SILVER_COLUMNS)


@query
def silver_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@query
def delay_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_counts(_silver(spark, sf_dir), "DELAY_CATEGORY")


# --- Gold


@query
def airport_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.airport_kpis(_silver(spark, sf_dir))


@query
def airline_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.airline_kpis(_silver(spark, sf_dir))


@query
def temporal_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.temporal_kpis(_silver(spark, sf_dir))


@query
def route_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.route_kpis(_silver(spark, sf_dir))


@query
def airport_kpis_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.airport_kpis_simple(_raw_2024(spark, sf_dir), MIN_AIRPORT)


@query
def airline_kpis_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.airline_kpis_simple(_raw_2024(spark, sf_dir), MIN_AIRLINE)


@query
def temporal_kpis_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.temporal_kpis_simple(_raw_2024(spark, sf_dir), MIN_TEMPORAL)


def _silver_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with arrival delays to the second: hardly any two are equal, and one airport owns
    half of the rows."""
    seconds = F.conv(F.substring(F.md5("flight_id"), 1, 4), 16, 10).cast("double") / 65536
    hot = F.when(F.substring(F.md5("flight_id"), 5, 1) < "8", "HUB").otherwise(F.col("Origin"))
    return _silver(spark, sf_dir).withColumns({"ArrDelay": F.col("ArrDelay") + seconds, "Origin": hot})


@query
def airport_kpis_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = kpis.airport_kpis(_silver_seconds(spark, sf_dir), fractional=True)
    return table.select(*table.columns[:3], *[F.round(c, 6).alias(c) for c in table.columns[3:]])


@query
def airline_kpis_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = kpis.airline_kpis(_silver_seconds(spark, sf_dir), fractional=True)
    return table.select(*table.columns[:3], *[F.round(c, 6).alias(c) for c in table.columns[3:]])


@query
def features_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


@query
def features_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.features_simple(_raw(spark, sf_dir))


@query
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_summary(features.features_simple(_raw(spark, sf_dir)))


@query
def carrier_month_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.carrier_month_topk(_silver(spark, sf_dir), 2023, CARRIERS)


@query
def carrier_month_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.carrier_month_rank(_silver(spark, sf_dir), 2023, CARRIERS)


@query
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_profile(kpis.temporal_kpis(_silver(spark, sf_dir)))


@query
def season_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.season_profile(kpis.temporal_kpis(_silver(spark, sf_dir)))


@query
def season_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_counts(_silver(spark, sf_dir), "SEASON")


@query
def target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_counts(_features(spark, sf_dir), "target_is_delayed")


@query
def target_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.describe_column(_features(spark, sf_dir), "target_arrival_delay")


@query
def worst_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_2024(spark, sf_dir)
    airports = reports.worst_best(kpis.airport_kpis_simple(raw, MIN_AIRPORT), "Origin")
    airlines = reports.worst_best(kpis.airline_kpis_simple(raw, MIN_AIRLINE), CARRIER)
    return airports.withColumn("table_name", F.lit("airport_analytics")).unionByName(
        airlines.withColumn("table_name", F.lit("airline_analytics"))
    )


@query
def worst_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = kpis.temporal_kpis_simple(_raw_2024(spark, sf_dir), MIN_TEMPORAL)
    return reports.worst_hours(table, ["Month", "DayOfWeek", "DEP_HOUR"])


@query
def worst_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = kpis.airport_kpis_simple(_raw_2024(spark, sf_dir), MIN_AIRPORT)
    return selection.top_k(table, [F.desc_nulls_first("avg_arrival_delay"), "Origin", "Month"], 10)


@query
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.sample_lowest(_silver(spark, sf_dir), 1000)


@query
def result_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_2024(spark, sf_dir)
    tables = gold.simple_tables(raw, MIN_AIRPORT, MIN_AIRLINE, MIN_TEMPORAL)
    return reports.result_sizes(tables)


def _lake(spark: SparkSession, sf_dir: str) -> Medallion:
    """A lake over a CSV source of all records, nothing in it yet."""
    lake = Medallion(scratch_path(spark, "lake"), scratch_path(spark, "source"))
    ingest.write_csv(_raw(spark, sf_dir), lake.source_csv, "gzip")
    return lake


@query
def lake_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layers from CSV to gold, run one after another: rows of every table they wrote."""
    lake = _lake(spark, sf_dir)
    for layer, report in run_layers(spark, lake, ["bronze", "silver", "gold"]).items():
        if isinstance(report, Exception):
            raise RuntimeError(f"layer {layer} failed") from report
    written = {name: snapshots.read(spark, path) for name, path in lake.tables().items()}
    return reports.result_sizes(written).select("table_name", "row_count")


@query
def lake_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as the models load it, written from silver."""
    lake = _lake(spark, sf_dir)
    gold.write_features(_silver(spark, sf_dir), lake.features)
    return models.prepare(snapshots.read(spark, lake.features))


@query
def table_else_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of the CSV source where there is no table, the whole table where there is one."""
    lake = _lake(spark, sf_dir)
    missing = ingest.table_or_csv(spark, lake.bronze, lake.source_csv, 2023)
    table = scratch_path(spark, "bronze")
    snapshots.commit(_bronze(spark, sf_dir).where("Month <= 6"), table, ["Year"])
    there = ingest.table_or_csv(spark, table, lake.source_csv, 2023)
    columns = ["flight_id", "Year", "Month"]
    return missing.select(*columns, F.lit("csv").alias("origin")).unionByName(
        there.select(*columns, F.lit("table").alias("origin"))
    )


# --- Table maintenance


@query
def compact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in two batches, clustered, then compacted: the rows stay what they were."""
    table = scratch_path(spark, "compact")
    rows = _silver(spark, sf_dir)
    early = F.col("Year") < 2021
    snapshots.commit(rows.where(early), table, gold.PARTITIONS, "append")
    snapshots.commit(rows.where(~early), table, gold.PARTITIONS, "append")
    maintenance.cluster(spark, table, ["Year", "Month", "AIRLINE"])
    maintenance.compact(spark, table)
    return cleaning.select_available(snapshots.read(spark, table))


@query
def z_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = maintenance.with_z_value(_silver(spark, sf_dir), ["Year", "Month", "AIRLINE"])
    return ranked.select("flight_id", F.col("_z").alias("z"))


@query
def vacuum_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.vacuum_preview(
        spark, history_table(spark, sf_dir), now=datetime(2024, 1, 20)
    )


@query
def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.history(spark, history_table(spark, sf_dir))


@query
def version_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.compare_versions(
        spark, history_table(spark, sf_dir), keys=["flight_id"]
    )


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch brings a new column; earlier rows read as null there."""
    table = scratch_path(spark, "evolve")
    rows = _raw_with_date(spark, sf_dir)
    late = F.col("Year") >= 2021
    snapshots.commit(rows.where(~late).drop("FL_DATE"), table, ["Year"])
    snapshots.commit(rows.where(late), table, ["Year"])
    merged = snapshots.read(spark, table)
    return merged.select("flight_id", "Year", "FL_DATE")


def _small_file_rows(rows: DataFrame) -> int:
    """Rows for each of many small files: three files a year at least, and more with the input."""
    return min(50_000, max(1, rows.count() // (3 * len(DEFAULT_YEARS))))


def _evolving(spark: SparkSession, sf_dir: str) -> str:
    """A table whose second batch brought a column; both batches in many small files."""
    table = scratch_path(spark, "evolving")
    rows = _raw(spark, sf_dir)
    late = F.col("Year") >= 2021
    few = _small_file_rows(rows)
    snapshots.commit(rows.where(~late), table, ["Year"], layout=False, rows_per_file=few)
    extra = rows.where(late).withColumn("extra", F.md5("flight_id"))
    snapshots.commit(extra, table, ["Year"], layout=False, rows_per_file=few)
    return table


@query
def evolved_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rewrite keeps the column that came later."""
    table = _evolving(spark, sf_dir)
    maintenance.compact(spark, table)
    maintenance.cluster(spark, table, ["Origin", "Dest"])
    return snapshots.read(spark, table).select("flight_id", "Year", "extra")


@query
def evolved_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """So does an upsert of rows without that column."""
    table = _evolving(spark, sf_dir)
    changed = _raw(spark, sf_dir).where((F.col("Year") == 2024) & (F.col("Month") == 1))
    changed = changed.withColumn("DepDelay", F.lit(1.0))
    snapshots.upsert(changed, table, ["Year", "flight_id"], ["Year"])
    return snapshots.read(spark, table).select("flight_id", "Year", "DepDelay", "extra")


@query
def string_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values with leading zeros stay texts, through a rewrite too."""
    table = scratch_path(spark, "codes")
    code = F.lpad((F.col("Month") * 7).cast("string"), 3, "0").alias("code")
    snapshots.commit(_raw(spark, sf_dir).select("flight_id", code), table, ["code"])
    maintenance.compact(spark, table, everything=True)
    return snapshots.read(spark, table).select("flight_id", "code")


@query
def z_value_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with more values than ranks."""
    ranked = maintenance.with_z_value(_silver(spark, sf_dir), ["Distance"])
    return ranked.select("flight_id", F.col("_z").alias("z"))


@query
def split_plain_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are plain numbers."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("key")
    return selection.split_hash(items.select(key), key="key")


@query
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with their columns in different orders."""
    rows, paths = _raw(spark, sf_dir), [scratch_path(spark, "csv") for _ in range(2)]
    early = F.col("Year") < 2021
    ingest.write_csv(rows.where(early), paths[0])
    ingest.write_csv(rows.where(~early).select(*reversed(rows.columns)), paths[1])
    read = ingest.read_mixed_csv(spark, paths)
    return read.select("flight_id", "Year", "Month", "Distance")


@query
def csv_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months written as 2.0 are counted, not turned into nulls."""
    path = scratch_path(spark, "csv")
    month = F.when(F.col("Month") == 2, "2.0x").otherwise(F.col("Month").cast("string"))
    ingest.write_csv(_raw(spark, sf_dir).select("Year", month.alias("Month")), path)
    return ingest.bad_values(spark, [path])


@query
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with three headers, types inferred over all of them."""
    rows, paths = _raw(spark, sf_dir), [scratch_path(spark, "csv") for _ in range(3)]
    columns = ["flight_id", "Year", "Month", "Origin", "CRSDepTime", "ArrDelay", "Distance"]
    for i, path in enumerate(paths):
        some = rows.where(F.col("Year") % 3 == i).select(*columns[i:], *columns[:i])
        ingest.write_csv(some.drop("Origin") if i == 2 else some, path)
    return ingest.read_untyped_csv(spark, paths)


@query
def reingest_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over a source with one changed year writes that year alone."""
    table, rows = scratch_path(spark, "unchanged"), _bronze(spark, sf_dir)
    ingest.ingest_years(rows, table)
    changed = F.when(F.col("Year") == 2021, F.col("DepDelay") + 1).otherwise(F.col("DepDelay"))
    again = rows.repartition(max(5, rows.count() // 1_000_000)).withColumn("DepDelay", changed)
    return ingest.ingest_years(again, table, skip_unchanged=True)


@query
def hourly_means_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over departure hours that are equal to the last bit on any cluster."""
    thirds = _silver(spark, sf_dir).select("DEP_HOUR", *[(F.col(c) / 3).alias(c) for c in ("ArrDelay", "DepDelay", "Distance")])
    return reports.exact_means(thirds, ["DEP_HOUR"], ["ArrDelay", "DepDelay", "Distance"])


@query
def reingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second source that lacks a year: its rows stay, and the report says so."""
    table, rows = scratch_path(spark, "reingest"), _bronze(spark, sf_dir)
    ingest.ingest_years(rows, table)
    return ingest.ingest_years(rows.where("Year <> 2020"), table)


@query
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the file counts and sizes, which depend on the layout."""
    stats = maintenance.tables_stats(
        spark, {"bronze": history_table(spark, sf_dir), "missing": scratch_path(spark, "none")}
    )
    return stats.select("table_name", "version", "row_count", F.col("error").isNotNull().alias("missing"))


@query
def compact_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in many small files, packed into few without a shuffle."""
    source, target = scratch_path(spark, "small"), scratch_path(spark, "packed")
    few = _small_file_rows(_raw(spark, sf_dir))
    _silver(spark, sf_dir).write.option("maxRecordsPerFile", few).partitionBy("Year").parquet(source)
    packing.compact_folder(spark, source, target, ["Year"])
    return cleaning.select_available(spark.read.parquet(target))


@query
def z_ranks_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten columns, one of them with as many values as rows: their ranks and the Z-value."""
    ranked, bits = zorder.with_ranks(_silver(spark, sf_dir), Z_COLUMNS)
    names = {f"_rank_{c}": b for c, b in bits.items()}
    ranks = [F.col(n).alias(f"r{i}") for i, n in enumerate(names)]
    return ranked.select("flight_id", *ranks, zorder.interleaved(names).alias("z"))


@query
def clustered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder clustered by ten columns has the rows it was made from."""
    path = scratch_path(spark, "clustered")
    zorder.write_clustered(_silver(spark, sf_dir), path, Z_COLUMNS, files=8)
    return cleaning.select_available(spark.read.parquet(path))


# --- Models


@query
def ml_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.prepare(_features(spark, sf_dir))


@query
def ml_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    numeric = list(models.FULL.numeric)
    scaled = models.scaled_numerics(models.prepare(_features(spark, sf_dir)), numeric)
    return scaled.select("flight_id", *[F.round(c, 6).alias(c) for c in numeric])


@query
def ml_onehot_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = selection.split_hash(models.prepare(_features(spark, sf_dir)))
    return models.onehot_widths(split.where(~F.col("is_test")))


@query
def ml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = selection.split_hash(models.prepare(_features(spark, sf_dir)))
    return split.select("flight_id", "is_test")


@query
def ml_split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = models.prepare(_features(spark, sf_dir))
    split = selection.split_stratified(prepared, models.CLASS_TARGET)
    return split.select("flight_id", models.CLASS_TARGET, "is_test")


@query
def metric_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metrics.regression_metrics(
        _features(spark, sf_dir), models.DELAY_TARGET, "DepDelay"
    )
    return scored.select(*[F.round(c, 6).alias(c) for c in scored.columns])


@query
def metric_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = (F.col("DepDelay") > 15).cast("int")
    scored = _features(spark, sf_dir).withColumn("prediction", guess)
    return metrics.accuracy(scored, models.CLASS_TARGET)


@query
def metric_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = metrics.roc_auc(_features(spark, sf_dir), models.CLASS_TARGET, "DepDelay")
    return spark.createDataFrame([(round(area, 6),)], "roc_auc double")


@query
def ml_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = selection.split_stratified(models.prepare(_features(spark, sf_dir)), models.CLASS_TARGET)
    return split.groupBy(models.CLASS_TARGET).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("is_test").alias("test_count")
    )


@query
def ml_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear model of one feature, fitted on all rows."""
    model = models.fit_line(_features(spark, sf_dir), "DepDelay")
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 6), round(float(model.intercept), 6))], "slope double, intercept double"
    )


@query
def ml_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = models.prepare(_features(spark, sf_dir))
    return models.checks(models.train_regression(prepared), spark)


@query
def ml_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = models.prepare(_features(spark, sf_dir))
    return models.checks(models.train_classification(prepared), spark)


@query
def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The simple feature set through both tasks, logged."""
    rows = models.prepare(features.features_simple(_raw(spark, sf_dir)), models.SIMPLE)
    trained = [
        *models.train_regression(rows, models.SIMPLE),
        *models.train_classification(rows, models.SIMPLE),
    ]
    models.log_runs(spark, trained, scratch_path(spark, "runs"))
    return models.checks(trained, spark)


@query
def ml_category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every category, numbered; the row key is one with as many values as rows."""
    rows = models.prepare(_features(spark, sf_dir))
    found = dictionary(rows, [*models.FULL.categorical, "flight_id"])
    return found.table.select("feature", "value", F.col("index").alias("value_index"))


@query
def ml_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the least-squares predictions add up to over each column of the design. The equations
    hold if that is what the target adds up to, and only the least-squares fit does that."""
    rows = written_once(models.prepare(_features(spark, sf_dir)), "prepared")
    train = selection.split_hash(rows).where(~F.col("is_test"))
    fit = linear.least_squares(train, models.FULL.numeric, models.FULL.categorical, models.DELAY_TARGET)
    found = linear.column_sums(models.predict(fit.regressor(), train), fit.design, "prediction")
    return found.select("feature", "value", "row_count", F.round(F.col("total") / F.col("row_count"), 6).alias("moment"))


@query
def ml_logistic_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the penalised logistic fit: the predicted probabilities and the coefficient
    add up to what the classes add up to."""
    rows = written_once(models.prepare(_features(spark, sf_dir)), "prepared")
    train = selection.split_stratified(rows, models.CLASS_TARGET).where(~F.col("is_test"))
    fit = linear.logistic(train, models.FULL.numeric, models.FULL.categorical, models.CLASS_TARGET)
    found = linear.column_sums(models.predict(fit.classifier(), train), fit.design, "probability_1")
    pulled = F.when(F.col("a.feature") == linear.INTERCEPT, 0.0).otherwise(F.col("coefficient"))
    same = (F.col("a.feature") == F.col("b.feature")) & F.col("a.value").eqNullSafe(F.col("b.value"))
    joined = found.alias("a").join(fit.table(spark).alias("b"), same)
    return joined.select("a.feature", "a.value", "row_count", F.round(F.col("total") + pulled, 5).alias("moment"))


def _carrier_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, models.Trained]:
    """Least squares on the carrier alone, whose predictions are the carriers' means."""
    rows = selection.split_hash(models.prepare(_features(spark, sf_dir)))
    train, held_out = rows.where(~F.col("is_test")), rows.where("is_test")
    model = linear.least_squares(train, [], ["AIRLINE"], models.DELAY_TARGET).regressor()
    scored = models.predict(model, held_out)
    found = metrics.regression_metrics(scored, models.DELAY_TARGET).first().asDict()
    return scored, models.Trained("regression", "carrier_means", model, found)


@query
def ml_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = _carrier_model(spark, sf_dir)
    return scored.select("flight_id", "AIRLINE", F.round("prediction", 6).alias("prediction"))


@query
def ml_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's holdout metrics as the run table has them."""
    _, trained = _carrier_model(spark, sf_dir)
    runs = models.log_runs(spark, [trained], scratch_path(spark, "runs"), feature_version=3)
    metric, value = F.explode("metrics").alias("metric", "value"), F.round("value", 6).alias("value")
    return runs.select("run_name", "feature_version", metric).select("run_name", "feature_version", "metric", value)


@query
def ml_permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a fixed linear score, by the squared error of the arrival delay."""
    rows = models.prepare(_features(spark, sf_dir))
    score = F.col("DepDelay") * 0.9 + F.col("Distance") * 0.002 - F.col("AirTime") * 0.01 + F.when(F.col("AIRLINE") < "BRAND#3", 2.0).otherwise(0.0)
    loss = F.avg(F.pow(F.col(models.DELAY_TARGET) - F.col("prediction"), 2))
    found = importance.permutation_importance(
        rows, ["DepDelay", "Distance", "AirTime", "AIRLINE"], lambda df: df.withColumn("prediction", score), loss
    )
    return found.select("feature", *[F.round(c, 6).alias(c) for c in found.columns[1:]])
