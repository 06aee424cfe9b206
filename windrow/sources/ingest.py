"""Sources: CSV scans, ingestion metadata and year-sliced ingestion into bronze."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.operators.cleaning import fill_nulls_by_type, filter_year
from windrow.schemas import FLIGHTS
from windrow.sources import snapshots
from windrow.sources.headers import files_by_header, read_inferred_csv

log = logging.getLogger(__name__)

#: Blanks around a value belong to it, on the way out and on the way in.
CSV_OPTIONS = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
#: Rows of a compressed CSV file at most.
ROWS_PER_FILE = 500_000


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = FLIGHTS,
    **options: str | bool,
) -> DataFrame:
    """Lazy scan of CSV with a header, columns matched by name.

    Columns named in ``schema`` get its types, others are text. Only the header line of one
    file is read to plan the scan; a file with another header, or a value that its type cannot
    hold, is an error when it is read (see ``read_mixed_csv`` and ``bad_values`` for such
    data). ``schema=None`` infers all types, which reads the data once more.
    """
    reader = spark.read.options(**CSV_OPTIONS).options(mode="FAILFAST", enforceSchema=False)
    reader = reader.options(**options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(_typed(reader.csv(path).columns, schema)).csv(path)


def _typed(columns: Sequence[str], schema: T.StructType) -> T.StructType:
    declared = {f.name: f.dataType for f in schema.fields}
    return T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in columns])


def read_mixed_csv(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType = FLIGHTS, **options: str | bool
) -> DataFrame:
    """CSV files whose headers differ, from files and folders: columns go by name, missing ones
    are null. One job finds the headers of all files."""
    frames = [
        read_csv(spark, group, schema, **options) for group in files_by_header(spark, paths).values()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_untyped_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV files whose headers differ, each column with the narrowest type of all its values."""
    return read_inferred_csv(spark, paths, CSV_OPTIONS)


def bad_values(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType = FLIGHTS
) -> DataFrame:
    """How many values of each declared column its type cannot hold (column_name, bad_count)."""
    rows = read_mixed_csv(spark, paths, T.StructType([]))
    checked = [f for f in schema.fields if f.name in rows.columns]
    wrong = [
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in checked
    ]
    pairs = [F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("bad_count")) for f in checked]
    return rows.agg(*wrong).select(F.inline(F.array(*pairs)))


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """One folder of CSV part files, written in parallel. Compressed files are read whole by a task,
    so they are cut at ROWS_PER_FILE rows."""
    writer = df.write.options(**CSV_OPTIONS).mode("overwrite")
    if compression:
        writer = writer.options(compression=compression, maxRecordsPerFile=ROWS_PER_FILE)
    writer.csv(path)


def with_ingest_metadata(df: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    when = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return df.withColumns({"ingested_at": when, "source_layer": F.lit("bronze")})


def ingest_years(
    source: DataFrame,
    table: str,
    years: Sequence[int] | None = None,
    fill_nulls: bool = False,
    committed_at: datetime | None = None,
    skip_unchanged: bool = False,
) -> DataFrame:
    """Writes years to bronze, partitioned by ``Year``, and reports each of them.

    ``years=None`` takes every year of the source, rows without one included. All years go in
    one job over the source, as one version. A year written before is replaced, so a second run
    changes nothing. A year without rows in the source is reported as empty, or as kept if the
    table has it from before. Should the one job fail, the years are retried one by one, so
    that a year that cannot be written is reported as failed and does not hold up the others.

    With ``skip_unchanged`` a year whose rows are those the table already has, in any order and
    apart from the time of ingestion, is reported as unchanged and not written again.
    """
    spark = source.sparkSession
    rows = fill_nulls_by_type(source) if fill_nulls else source
    before = snapshots.current_version(spark, table)
    had: set[int | None] = set()
    if before is not None:
        had = {r["Year"] for r in snapshots.read(spark, table).select("Year").distinct().collect()}

    same: set[int | None] = set()
    if skip_unchanged and before is not None:
        same = unchanged_years(rows, snapshots.read(spark, table).drop(*snapshots.VERSION_COLUMNS))
        asked = [r["Year"] for r in rows.select("Year").distinct().collect()] if years is None else list(years)
        reported, years = asked, [y for y in asked if y not in same]
        same &= set(reported)

    def write(batch: Sequence[int | None] | None) -> int:
        some = rows
        if batch is not None:
            known = F.col("Year").isin(*[y for y in batch if y is not None])
            some = rows.where(known | F.col("Year").isNull() if None in batch else known)
        return snapshots.commit(some, table, ["Year"], "replace", committed_at)

    failed = []
    try:
        versions = [write(years)] if years or not same else []
    except Exception:
        log.exception("ingesting %s in one job failed, retrying year by year", years)
        versions = []
        if years is None:
            years = [r["Year"] for r in rows.select("Year").distinct().collect()]
        for year in years:
            try:
                versions.append(write([year]))
            except Exception:
                log.exception("ingesting %s failed", year)
                failed.append(year)

    try:
        written = (
            snapshots.read_versions(spark, table, versions)
            .groupBy("Year")
            .agg(F.count(F.lit(1)).alias("row_count"))
        )
    except snapshots.VersionNotFound:
        written = spark.createDataFrame([], "Year int, row_count long")
    if years is None:
        # One row for each partition folder just written.
        years = [r["Year"] for r in written.select("Year").collect()]
        years += sorted(had - set(years), key=str)
    report = spark.createDataFrame(
        [(y, y in failed, y in had, y in same) for y in [*years, *sorted(same, key=str)]],
        "Year int, failed boolean, had boolean, same boolean",
    )
    written = written.withColumnRenamed("Year", "_year")
    same_year = F.col("Year").eqNullSafe(F.col("_year"))
    return report.join(written, same_year, "left").select(
        "Year",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.when(F.col("same"), "unchanged")
        .when(F.col("failed"), "failed")
        .when(F.col("row_count") > 0, "written")
        .when(F.col("had"), "kept")
        .otherwise("empty")
        .alias("status"),
    )


def year_digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Year, and a digest of its rows that does not depend on their order: how many they are, and
    the sums of two hashes of each. Repeated rows count as often as they stand there."""
    sums = [
        F.sum(F.xxhash64(*columns, F.lit(salt)).cast("decimal(20,0)")).alias(f"_sum{salt}") for salt in (1, 2)
    ]
    return rows.groupBy("Year").agg(F.count("*").alias("_rows"), *sums)


def unchanged_years(rows: DataFrame, table: DataFrame) -> set[int | None]:
    """Years of ``rows`` that ``table`` has just so. Tables with other columns or types have none."""
    compared = sorted(set(rows.columns) - {"ingested_at"})
    if dict(rows.select(compared).dtypes) != dict(table.drop("ingested_at").dtypes):
        return set()
    new, old = year_digests(rows, compared).alias("n"), year_digests(table, compared).alias("o")
    equal = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("Year", "_rows", "_sum1", "_sum2")]
    # One row for each year.
    return {r["Year"] for r in new.join(old, reduce(lambda a, b: a & b, equal)).select("n.Year").collect()}


def table_or_csv(
    spark: SparkSession, table: str, csv: str, year: int | None = 2024
) -> DataFrame:
    """Newest snapshot of a table, or one year of the raw CSV where the table is missing."""
    if snapshots.commits(spark, table):
        return snapshots.read(spark, table)
    raw = read_csv(spark, csv)
    return raw if year is None else filter_year(raw, year)
