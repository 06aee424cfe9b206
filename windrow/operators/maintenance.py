"""Maintenance of snapshot tables: compaction, clustering, vacuum, history and statistics."""

from __future__ import annotations

import contextlib
import io
import logging
import math
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.operators import packing
from windrow.operators.ranks import with_running_total
from windrow.schemas import RETENTION_HOURS, TARGET_FILE_BYTES
from windrow.session import written_once
from windrow.sources import snapshots

log = logging.getLogger(__name__)

#: Ranks per clustered column: 8 bits, so up to seven columns interleave into one long.
RANK_BITS = 8
MAX_RANKS = 2**RANK_BITS


def table_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Path and size of every data file below the folders; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folders)
        .select("path", "length")
    )


def _rewrite(
    spark: SparkSession,
    table: str,
    operation: str,
    order: Sequence[str],
    rows: DataFrame,
    total_bytes: int,
    target_bytes: int,
    committed_at: datetime | None,
) -> int:
    """Writes ``rows`` in files of about the target size, sorted by ``order``.

    Rows are range-partitioned by partition columns, ``order`` and a row hash: the hash lets
    Spark cut through one partition or one cluster value that holds most of the rows.
    """
    partition_by = snapshots.partition_columns(spark, table)
    lost = set(snapshots.read(spark, table).columns) - set(rows.columns) - set(snapshots.VERSION_COLUMNS)
    if lost:
        raise ValueError(f"a rewrite of {table} would lose {sorted(lost)}")
    ranges = [*partition_by, *order]
    spread = F.xxhash64(*[c for c in rows.columns if c not in order])
    files = max(1, math.ceil(total_bytes / target_bytes))
    moved = rows.withColumn("_spread", spread).repartitionByRange(files, *ranges, "_spread")
    laid_out = moved.sortWithinPartitions(*ranges) if ranges else moved
    helpers = ["_spread", *[c for c in order if c.startswith("_")]]
    return snapshots.commit(
        laid_out.drop(*helpers), table, partition_by, operation, committed_at, layout=False
    )


def _files(spark: SparkSession, table: str) -> DataFrame:
    """Folder, partition (as in the folder's name) and bytes of every file of the newest version."""
    files = table_files(spark, snapshots.live_folders(spark, table))
    return files.select(
        "path",
        F.regexp_extract("path", "/_committed_at=[^/]*/(.*?)[^/]*$", 1).alias("partition"),
        "length",
    )


def compact(
    spark: SparkSession,
    table: str,
    target_bytes: int = TARGET_FILE_BYTES,
    committed_at: datetime | None = None,
    everything: bool = False,
) -> int:
    """Merges small files into files of about ``target_bytes``; returns the newest version.

    Only partitions with at least two files below half the target are rewritten, each pack of
    files by one task and without a shuffle; if there are none, nothing is written. ``everything``
    writes the whole table anew, in packs as well; with a file of more than twice the target, or of
    too many packs for one plan, its rows are dealt out by ranges.
    """
    files = _files(spark, table)
    partition_by = snapshots.partition_columns(spark, table)
    if everything and partition_by:
        sizes = files.agg(F.coalesce(F.max("length"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
        if sizes[0] <= 2 * target_bytes and sizes[1] <= target_bytes * packing.PACKS_AT_ONCE:
            packed = packing.packs(files, target_bytes, F.col("partition"))
            if packed and len(packed) <= packing.PACKS_AT_ONCE:
                return _write_packed(spark, table, packed, "compact", committed_at)
    if everything or not partition_by:
        small = files.where(F.col("length") < target_bytes / 2).count()
        if small < 2 and not everything:
            return snapshots.current_version(spark, table)
        total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        rows = snapshots.read(spark, table).drop(*snapshots.VERSION_COLUMNS)
        return _rewrite(spark, table, "compact", [], rows, total, target_bytes, committed_at)
    small = F.count_if(F.col("length") < target_bytes / 2)
    needy = files.groupBy("partition").agg(small.alias("small")).where("small > 1")
    packed = packing.packs(files.join(needy, "partition"), target_bytes, F.col("partition"))
    if not packed:
        return snapshots.current_version(spark, table)
    return _write_packed(spark, table, packed, "replace", committed_at)


def _write_packed(
    spark: SparkSession, table: str, packed: list[list[str]], operation: str, committed_at: datetime | None
) -> int:
    """Writes the rows of the packs as a version, each pack by one task."""
    fields = [f for f in snapshots.read(spark, table).schema if f.name not in snapshots.VERSION_COLUMNS]
    reader = spark.read.option("basePath", table).schema(T.StructType(fields))
    rows = packing.read_packed(packed, lambda paths: reader.parquet(*paths).drop(*snapshots.VERSION_COLUMNS))
    partition_by = snapshots.partition_columns(spark, table)
    with packing.one_task_a_pack(spark):
        return snapshots.commit(rows, table, partition_by, operation, committed_at, layout=False)


def rank_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Sorted lower bounds of the ranks of each column, at most 256.

    The bounds are exact quantiles of the column's distinct values, so each rank has about as
    many values as any other: one each where there are no more values than ranks.
    """
    bounds = {}
    for c in columns:
        values = df.select(F.col(c).alias("_v")).where(F.col("_v").isNotNull()).distinct()
        places = with_running_total(values.withColumn("_one", F.lit(1)), "_v", "_one", "_place")
        places = places.select("_v", (F.col("_place") - 1).alias("_place"))
        distinct = places.count()
        ranks = min(MAX_RANKS, max(distinct, 1))
        rank = F.floor(F.col("_place") * ranks / distinct) if distinct else F.lit(0)
        before = F.floor((F.col("_place") - 1) * ranks / distinct) if distinct else F.lit(0)
        starts = places.where((F.col("_place") == 0) | (rank > before)).select("_v")
        bounds[c] = sorted(row["_v"] for row in starts.collect())
    return bounds


def rank_of(column: str, bounds: list) -> Column:
    """Index of the last bound at or below the value, by binary search; 0 for null."""

    def search(low: int, high: int) -> Column:
        if high - low <= 1:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) >= F.lit(bounds[middle]), search(middle, high)).otherwise(
            search(low, middle)
        )

    return search(0, len(bounds))


def z_value(ranks: Sequence[Column], bits: Sequence[int]) -> Column:
    """Bits of the ranks interleaved, those of the first rank lowest."""
    width = len(ranks)
    if width * RANK_BITS > 63:
        raise ValueError("at most seven columns can be clustered")
    z = F.lit(0).cast("long")
    for place, rank in enumerate(ranks):
        for bit in range(bits[place]):
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(taken, bit * width + place))
    return z


def with_z_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``_z``, close for rows that are close in all of the columns."""
    bounds = rank_bounds(df, columns)
    ranks = {f"_rank_{c}": rank_of(c, bounds[c]).cast("long") for c in columns}
    bits = [max(len(bounds[c]) - 1, 0).bit_length() for c in columns]
    z = z_value([F.col(name) for name in ranks], bits)
    return df.withColumns(ranks).withColumn("_z", z).drop(*ranks)


def cluster(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
    committed_at: datetime | None = None,
) -> int:
    """Rewrites the newest version so that rows close in all ``columns`` share files."""
    rows = snapshots.read(spark, table).drop(*snapshots.VERSION_COLUMNS)
    rows = with_z_value(rows, columns)
    total = _files(spark, table).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return _rewrite(spark, table, "cluster", ["_z"], rows, total, target_bytes, committed_at)


def vacuum_candidates(
    spark: SparkSession,
    table: str,
    retention_hours: float = RETENTION_HOURS,
    now: datetime | None = None,
) -> list[snapshots.Commit]:
    """Versions that no read of the retention period needs.

    A version goes once a full rewrite has taken its place for longer than the retention;
    the newest version, and all that it is made of, always stays.
    """
    cutoff = snapshots._utc(now or datetime.now(UTC)) - timedelta(hours=retention_hours)
    known = snapshots.commits(spark, table)
    rewrites = [c.version for c in known if c.full and c.committed_at <= cutoff]
    return [c for c in known if rewrites and c.version < rewrites[-1]]


def vacuum_preview(
    spark: SparkSession,
    table: str,
    retention_hours: float = RETENTION_HOURS,
    now: datetime | None = None,
) -> DataFrame:
    """The dry run: what ``vacuum`` would remove, with the rows each version wrote."""
    doomed = vacuum_candidates(spark, table, retention_hours, now)
    return history(spark, table, doomed)


def vacuum(
    spark: SparkSession,
    table: str,
    retention_hours: float = RETENTION_HOURS,
    now: datetime | None = None,
) -> int:
    """Removes the folders of the candidates and returns the number of data files removed."""
    doomed = vacuum_candidates(spark, table, retention_hours, now)
    if not doomed:
        return 0
    files = table_files(spark, [c.path for c in doomed]).count()
    for old in doomed:
        folder = snapshots._hadoop_path(spark, f"{table}/_version={old.version}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return files


def history(
    spark: SparkSession, table: str, versions: list[snapshots.Commit] | None = None
) -> DataFrame:
    """Versions, newest first, with the rows each one wrote (counted from file footers)."""
    listed = snapshots.commits(spark, table) if versions is None else versions
    rows = [(c.version, c.operation, c.committed_at) for c in listed]
    names = spark.createDataFrame(
        rows, "_version int, _operation string, _committed_at timestamp"
    )
    if not listed:
        return names.withColumn("row_count", F.lit(0).cast("long"))
    counts = (
        snapshots.read_versions(spark, table, [c.version for c in listed])
        .groupBy("_version")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return (
        names.join(counts, "_version", "left")
        .withColumn("row_count", F.coalesce("row_count", F.lit(0)))
        .orderBy(F.desc("_version"))
    )


def table_info(spark: SparkSession, table: str) -> dict:
    """Version, partition columns, creation time, file count, bytes and five sample files."""
    known = snapshots.commits(spark, table)
    if not known:
        raise snapshots.VersionNotFound(f"{table} has no versions")
    files = table_files(spark, snapshots.live_folders(spark, table))
    totals = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    return {
        "version": known[-1].version,
        "partition_columns": snapshots.partition_columns(spark, table),
        "created_at": known[0].committed_at,
        "file_count": totals[0],
        "size_bytes": totals[1],
        "files": [r["path"] for r in files.orderBy("path").limit(5).collect()],
    }


def tables_stats(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Version, files, bytes and rows of each table; an error text where one is missing."""
    schema = (
        "table_name string, version int, file_count long, size_bytes long, "
        "row_count long, error string"
    )
    rows = []
    for name, table in tables.items():
        try:
            info = table_info(spark, table)
            count = snapshots.read(spark, table).count()
            rows.append(
                (name, info["version"], info["file_count"], info["size_bytes"], count, None)
            )
        except Exception as error:
            rows.append((name, None, None, None, None, str(error)))
    return spark.createDataFrame(rows, schema)


def compare_versions(
    spark: SparkSession,
    table: str,
    old: int | None = None,
    new: int | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Row counts of two versions (the newest two by default), one row each.

    With ``keys``, also how many keys the newer version added and removed. Only partitions that one
    version alone has go through an aggregation by key; the others are looked up for the keys that
    this finds on one side.
    """
    known = [c.version for c in snapshots.commits(spark, table)]
    if old is None or new is None:
        if len(known) < 2:
            raise snapshots.VersionNotFound(f"{table} has fewer than two versions")
        old, new = known[-2], known[-1]
    if keys is None:
        sides = [snapshots.read(spark, table, v).select(F.lit(v).alias("version")) for v in (old, new)]
        return sides[0].unionByName(sides[1]).groupBy("version").agg(F.count(F.lit(1)).alias("row_count"))
    folders = {v: set(snapshots.leaf_folders(spark, table, v)) for v in (old, new)}
    shared = folders[old] & folders[new]
    own = [
        snapshots.read_leaves(spark, table, sorted(folders[v] - shared), v).select(*keys, F.lit(v == new).alias("_newer"))
        for v in (old, new)
    ]
    both = snapshots.read_leaves(spark, table, sorted(shared), new).select(*keys)
    rows = [both.count() + side.count() for side in own]
    present = own[0].unionByName(own[1]).groupBy(*keys).agg(
        F.count_if(~F.col("_newer")).alias("_old"), F.count_if("_newer").alias("_new")
    )
    changed = present.where("_old = 0 or _new = 0")
    if shared:
        # A key that also stands in a folder of both versions is in both.
        changed = written_once(changed, "changed-keys")
        other = changed.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
        found = both.join(other, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys], "left_semi")
        found = found.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
        changed = changed.join(found, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys], "left_anti")
    totals = changed.agg(F.count_if(F.col("_old") == 0).alias("_added"), F.count_if(F.col("_new") == 0).alias("_removed"))
    totals = totals.withColumns({"_old_rows": F.lit(rows[0]).cast("long"), "_new_rows": F.lit(rows[1]).cast("long")})
    nothing = F.lit(0).cast("long")
    return totals.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit(old).alias("version"),
                    F.col("_old_rows").alias("row_count"),
                    nothing.alias("added_keys"),
                    nothing.alias("removed_keys"),
                ),
                F.struct(
                    F.lit(new).alias("version"),
                    F.col("_new_rows").alias("row_count"),
                    F.col("_added").alias("added_keys"),
                    F.col("_removed").alias("removed_keys"),
                ),
            )
        )
    )


def schema_of(spark: SparkSession, table: str) -> DataFrame:
    """Columns of the newest version across its files, old ones lacking some included."""
    merged = snapshots.read(spark, table)
    fields = [
        (i, f.name, f.dataType.simpleString())
        for i, f in enumerate(merged.schema.fields)
        if f.name not in snapshots.VERSION_COLUMNS
    ]
    return spark.createDataFrame(fields, "position int, column_name string, data_type string")


def optimize_tables(
    spark: SparkSession,
    tables: dict[str, str],
    cluster_columns: dict[str, Sequence[str]],
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Compacts each table, or clusters it where columns are named; goes on after an error.

    Clustering rewrites the whole table in target-size files, so a clustered table is not
    compacted first.
    """
    rows = []
    for name, table in tables.items():
        if not snapshots.commits(spark, table):
            continue
        try:
            columns = cluster_columns.get(name)
            if columns:
                version = cluster(spark, table, columns, target_bytes)
            else:
                version = compact(spark, table, target_bytes)
            rows.append((name, version, None))
        except Exception as error:
            log.exception("optimising %s failed", name)
            rows.append((name, None, str(error)))
    return spark.createDataFrame(rows, "table_name string, version int, error string")


def vacuum_tables(
    spark: SparkSession,
    tables: dict[str, str],
    retention_hours: float = RETENTION_HOURS,
    now: datetime | None = None,
) -> DataFrame:
    """Vacuums each table; goes on after an error."""
    rows = []
    for name, table in tables.items():
        try:
            rows.append((name, vacuum(spark, table, retention_hours, now), None))
        except Exception as error:
            log.exception("vacuuming %s failed", name)
            rows.append((name, None, str(error)))
    return spark.createDataFrame(rows, "table_name string, removed_files long, error string")


def explain(df: DataFrame, mode: str = "formatted") -> str:
    """The plan of a query as text, without running it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()
