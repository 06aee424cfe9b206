"""Session settings and the scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_roots: dict[str, str] = {}

#: How tables are compressed: texts like hashes take half the room that they take by default.
COMPRESSION = "zstd"
#: Partition folders a task writes to side by side. A task with rows of more sorts them first.
OPEN_FOLDERS = 16
_OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Whether the files of a query's shuffles go when it has ended, or when the driver collects garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str | int = "*", app: str = "windrow", **conf: str) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # Recording the Python call site of every column doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared folder the cluster names.

    Every executor must see what a job writes, so the folder is the session's
    ``spark.checkpoint.dir``. Only a session on one machine may do without: it gets one
    temporary folder; a cluster is refused. The path is removed when the session ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_roots.setdefault(context.applicationId, "") or tempfile.mkdtemp("", "windrow-")
        _own_roots[context.applicationId] = root
    path = f"{root.rstrip('/')}/windrow/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


@contextmanager
def _with_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Within it, rows that go to few partition folders are not sorted by these to be written, so
    a large task does not spill."""
    with _with_conf(spark, _OPEN_FOLDERS, str(OPEN_FOLDERS)):
        yield


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, what a write has dealt out goes from the disks as soon as it is written, so writes
    that follow one another do not add up."""
    with _with_conf(spark, _FREE_SHUFFLES, "true"):
        yield


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to scratch and reads it back: it is worked out once, and is the same
    wherever it is used."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
