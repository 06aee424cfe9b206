"""Versioned Parquet tables: every write is a new folder, nothing is changed in place.

A commit is one Spark write below::

    <table>/_version=3/_operation=append/_committed_at=20240104T000000.000000Z/<partitions>

The three levels are ordinary partition columns, so version, operation and commit time come
with every row at no storage cost, and a version counts once Spark has put its ``_SUCCESS``
file there. What a table holds at version *v* follows from the operations up to *v*:

* ``append`` adds rows;
* ``replace`` puts its partitions in the place of the same partitions of earlier versions;
* every other operation (``overwrite``, ``upsert``, ``compact``, ``cluster``) is a full rewrite.

One writer at a time is assumed. The folders a read needs are worked out from folder names
(versions times partitions, never files or rows), so only those are listed and scanned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.session import COMPRESSION, freed_shuffles, unsorted_writes, written_once

#: Operations that keep what earlier versions wrote.
INCREMENTAL = ("append", "replace")
#: Folder with the schema of a commit and no rows; hidden from scans of the commit.
EMPTY = "_empty"
#: Partitions of an upsert that are named in its filter.
MAX_TOUCHED = 500
STAMP = "%Y%m%dT%H%M%S.%fZ"
VERSION_FIELDS = [
    T.StructField("_version", T.IntegerType()),
    T.StructField("_operation", T.StringType()),
    T.StructField("_committed_at", T.StringType()),
]
VERSION_COLUMNS = [f.name for f in VERSION_FIELDS]


class VersionNotFound(LookupError):
    """The asked version was never written or has been vacuumed."""


@dataclass(frozen=True)
class Commit:
    version: int
    operation: str
    committed_at: datetime
    path: str

    @property
    def full(self) -> bool:
        return self.operation not in INCREMENTAL


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = _hadoop_path(spark, pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in fs.globStatus(path) or []]


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_glob(spark, path))


def commits(spark: SparkSession, table: str) -> list[Commit]:
    """Completed commits, oldest first."""
    found = []
    for marker in _glob(spark, f"{table}/_version=*/_operation=*/_committed_at=*/_SUCCESS"):
        folder = marker.rsplit("/", 1)[0]
        version, operation, stamp = (
            level.split("=", 1)[1] for level in folder.rsplit("/", 3)[1:]
        )
        when = datetime.strptime(stamp, STAMP).replace(tzinfo=UTC)
        found.append(Commit(int(version), operation, when, folder))
    return sorted(found, key=lambda c: c.version)


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def next_version(spark: SparkSession, table: str) -> int:
    """One above every version folder, also those of writes that never completed."""
    taken = [int(p.rsplit("=", 1)[1]) for p in _glob(spark, f"{table}/_version=*")]
    return max(taken, default=-1) + 1


def commit(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    operation: str = "append",
    committed_at: datetime | None = None,
    layout: bool = True,
    rows_per_file: int | None = None,
) -> int:
    """Writes ``df`` as the next version and returns its number.

    Rows are rebalanced by partition on the way: Spark merges small partitions and splits one
    that holds most of the rows, so file sizes follow the advisory partition size whatever
    the skew. ``layout=False`` keeps the row order and partitioning of ``df``. ``rows_per_file``
    cuts files at that many rows.
    """
    spark = df.sparkSession
    version = next_version(spark, table)
    stamp = _utc(committed_at or datetime.now(UTC)).strftime(STAMP)
    rows = df.drop(*VERSION_COLUMNS)
    if layout:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.mode("errorifexists").option("compression", COMPRESSION)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    folder = f"{table}/_version={version}/_operation={operation}/_committed_at={stamp}"
    with unsorted_writes(spark), freed_shuffles(spark):
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)
    # The columns and types of this commit, those of the partitions too, for readers.
    spark.createDataFrame([], rows.schema).write.parquet(f"{folder}/{EMPTY}")
    return version


def _partitions(spark: SparkSession, commit: Commit) -> list[str]:
    """Leaf partition folders of a commit, relative to it; ``[""]`` if unpartitioned."""
    leaves, level = [""], _glob(spark, f"{commit.path}/*=*")
    while level:
        leaves = [p[p.index(commit.path) + len(commit.path) :] for p in level]
        depth = leaves[0].count("/") + 1
        level = _glob(spark, commit.path + "/*=*" * depth)
    return leaves


def _has_data(spark: SparkSession, folder: str) -> bool:
    return bool(_glob(spark, f"{folder}/[!_.]*"))


def _history_to(spark: SparkSession, table: str, version: int | None) -> list[Commit]:
    """Commits that make up a version: from its last full rewrite, or from version 0."""
    known = commits(spark, table)
    if version is None:
        if not known:
            raise VersionNotFound(f"{table} has no versions")
        version = known[-1].version
    chain = [c for c in known if c.version <= version]
    if not chain or chain[-1].version != version:
        raise VersionNotFound(f"{table} has no version {version}")
    starts = [i for i, c in enumerate(chain) if c.full]
    chain = chain[starts[-1] :] if starts else chain
    if not starts and _vacuumed(spark, table, chain[0].version):
        raise VersionNotFound(f"version {version} of {table} has been vacuumed")
    return chain


def _vacuumed(spark: SparkSession, table: str, first: int) -> bool:
    """Whether versions before ``first`` were removed (failed writes leave their folder)."""
    folders = {int(p.rsplit("=", 1)[1]) for p in _glob(spark, f"{table}/_version=*")}
    return any(v not in folders for v in range(first))


def live_folders(spark: SparkSession, table: str, version: int | None = None) -> list[str]:
    """Folders that hold the rows of a version; for one without rows, its empty folder."""
    live: list[tuple[Commit, list[str] | None]] = []
    chain = _history_to(spark, table, version)
    for step in chain:
        if step.full:
            live = []
        elif step.operation == "replace" and live:
            new = set(_partitions(spark, step))
            live = [
                (c, [p for p in (parts or _partitions(spark, c)) if p not in new])
                for c, parts in live
            ]
            live = [(c, parts) for c, parts in live if parts]
        if _has_data(spark, step.path):
            live.append((step, None))
    if not live:
        return [f"{chain[-1].path}/{EMPTY}"]
    return [c.path + p for c, parts in live for p in ([""] if parts is None else parts)]


def leaf_folders(spark: SparkSession, table: str, version: int) -> list[str]:
    """The partition folders that hold the rows of a version."""
    whole = {c.path: c for c in commits(spark, table)}
    live = live_folders(spark, table, version)
    return [f + p for f in live for p in (_partitions(spark, whole[f]) if f in whole else [""])]


def read_leaves(spark: SparkSession, table: str, folders: list[str], version: int) -> DataFrame:
    """Rows of some folders of a version, with the columns of the version; no folders, no rows."""
    steps = _history_to(spark, table, version)
    return _load(spark, table, folders or [f"{steps[-1].path}/{EMPTY}"], schema_of_commits(spark, steps))


def schema_of_commits(spark: SparkSession, steps: Sequence[Commit]) -> T.StructType:
    """All columns the commits wrote, with the types they were written with: one footer each."""
    folders = [f"{step.path}/{EMPTY}" for step in steps]
    return spark.read.option("mergeSchema", True).parquet(*folders).schema


def _load(
    spark: SparkSession, table: str, folders: list[str], schema: T.StructType
) -> DataFrame:
    """Rows of the folders; nothing is inferred, neither columns nor partition values."""
    reader = spark.read.option("basePath", table)
    reader = reader.schema(T.StructType([*schema.fields, *VERSION_FIELDS]))
    stamp = F.to_timestamp("_committed_at", "yyyyMMdd'T'HHmmss.SSSSSSX")
    return reader.parquet(*folders).withColumn("_committed_at", stamp)


def read(
    spark: SparkSession,
    table: str,
    version: int | None = None,
    timestamp: datetime | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of a version (version 0 included), or of the newest one, with every column that a
    commit it is made of has (null where another lacks it).

    ``timestamp`` picks the newest version committed at or before it. Version, operation and
    commit time of the write that brought each row are in ``_version``, ``_operation`` and
    ``_committed_at``. A given ``schema`` saves the job that looks it up in the files.
    """
    if timestamp is not None:
        version = version_at(spark, table, timestamp)
    chain = _history_to(spark, table, version)
    folders = live_folders(spark, table, version)
    return _load(spark, table, folders, schema or schema_of_commits(spark, chain))


def read_folders(spark: SparkSession, table: str, folders: list[str]) -> DataFrame:
    """Rows in some folders of the newest version, with all its columns."""
    return _load(spark, table, folders, schema_of_commits(spark, _history_to(spark, table, None)))


def time_travel(
    spark: SparkSession,
    table: str,
    version: int | None = None,
    timestamp: datetime | None = None,
) -> DataFrame:
    """As ``read``, for one of the two; neither is an error."""
    if version is None and timestamp is None:
        raise ValueError("either version or timestamp must be given")
    return read(spark, table, version, None if version is not None else timestamp)


def read_versions(spark: SparkSession, table: str, versions: Sequence[int]) -> DataFrame:
    """Just the rows the given commits wrote."""
    steps = [c for c in commits(spark, table) if c.version in versions]
    wanted = [c.path for c in steps]
    if not wanted:
        raise VersionNotFound(f"{table} has none of the versions {list(versions)}")
    full = [folder for folder in wanted if _has_data(spark, folder)]
    folders = full or [f"{wanted[-1]}/{EMPTY}"]
    return _load(spark, table, folders, schema_of_commits(spark, steps))


def version_at(spark: SparkSession, table: str, timestamp: datetime) -> int:
    moment = _utc(timestamp)
    known = [c.version for c in commits(spark, table) if c.committed_at <= moment]
    if not known:
        raise VersionNotFound(f"{table} has no version at {timestamp}")
    return max(known)


def current_version(spark: SparkSession, table: str) -> int | None:
    known = commits(spark, table)
    return known[-1].version if known else None


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Names of the partition columns, from the newest version that has rows."""
    for known in reversed(commits(spark, table)):
        if _has_data(spark, known.path):
            leaf = _partitions(spark, known)[0]
            return [level.split("=", 1)[0] for level in leaf.split("/") if level]
    return []


def upsert(
    new: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    committed_at: datetime | None = None,
) -> int:
    """Replaces rows with the same key and adds the rest, as a new version.

    When the partition columns are part of the key, a key cannot sit in another partition:
    only partitions that ``new`` touches are read and replaced. Otherwise the whole table is
    rewritten. A key that comes twice in ``new`` is an error. Columns that only one side has
    are kept, null on the other.
    """
    spark = new.sparkSession
    new = written_once(new.drop(*VERSION_COLUMNS), "upsert")
    if new.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"the new rows repeat a key ({', '.join(keys)})")
    if current_version(spark, table) is None:
        return commit(new, table, partition_by, "overwrite", committed_at)
    existing = read(spark, table).drop(*VERSION_COLUMNS)
    operation = "upsert"
    if partition_by and set(partition_by) <= set(keys):
        existing, operation = _touched(existing, new, partition_by), "replace"
    incoming = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same_key = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    kept = existing.join(incoming, same_key, "left_anti")
    merged = kept.unionByName(new, allowMissingColumns=True)
    return commit(merged, table, partition_by, operation, committed_at)


def _touched(existing: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the partitions that ``new`` has rows in.

    The driver gets the distinct partitions, as it does the folders of any table, and only these
    folders are read. Of more than MAX_TOUCHED, the least and greatest value of each partition
    column (one row) prune the folders, and a semi-join is exact.
    """
    touched = written_once(new.select(*columns).distinct(), "touched")
    some = touched.limit(MAX_TOUCHED + 1).collect()
    if len(some) <= MAX_TOUCHED:
        same = [reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns]) for row in some]
        return existing.where(reduce(or_, same, F.lit(False)))
    ends = [f for c in columns for f in (F.min(c), F.max(c), F.count_if(F.col(c).isNull()))]
    row = new.agg(*ends).first()
    for place, c in enumerate(columns):
        low, high, nulls = row[3 * place : 3 * place + 3]
        inside = F.lit(False) if low is None else F.col(c).between(F.lit(low), F.lit(high))
        existing = existing.where(inside | F.col(c).isNull() if nulls else inside)
    wanted = touched.select(*[F.col(c).alias(f"_in_{c}") for c in columns])
    same = [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in columns]
    return existing.join(wanted, same, "left_semi")


def merge_with_existing(
    new: DataFrame,
    table: str,
    keys: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    committed_at: datetime | None = None,
) -> int:
    """Overwrites the table with ``new``, or upserts by ``keys`` when they are given."""
    if keys is None:
        return commit(new, table, partition_by, "overwrite", committed_at)
    return upsert(new, table, keys, partition_by, committed_at)
