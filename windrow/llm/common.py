"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, and a word, as classes that Java, Python and RE2 read alike.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_own_folders: dict[str, str] = {}
#: What empties a worker's tables that outlive a task, by the operator they serve.
CACHES: dict[str, Callable[[], object]] = {}
#: What empties tables that are cheap to build again.
SCRATCH: list[Callable[[], object]] = []
#: Rows of an Arrow batch that become Python objects together.
ROWS_AT_ONCE = 256

Batches = Iterator[pa.RecordBatch]


def release_memory() -> None:
    """Gives memory that is no longer in use back to the machine: workers are used again by later
    stages, and what an allocator keeps counts against the executor all the while."""
    for clear in SCRATCH:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(task: Callable[[Batches], Batches], keeps: str = "") -> Callable[[Batches], Batches]:
    """A task over Arrow batches that first drops other operators' tables from its worker and
    releases memory when it ends."""

    @wraps(task)
    def run(batches: Batches) -> Batches:
        for name, clear in CACHES.items():
            if name != keeps:
                clear()
        try:
            yield from task(batches)
        finally:
            release_memory()

    return run


def in_slices(batches: Batches, rows: int = ROWS_AT_ONCE) -> Batches:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def let_workers_import(spark: SparkSession) -> None:
    """Puts this package's folder on the import path of Python workers.

    Workers then find the package although only the driver's path was changed; a cluster whose
    machines hold it elsewhere (or get it by ``--py-files``) is not affected.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a temporary folder; a cluster
    without it is refused, as its executors could not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="windrow-llm-")
    return _own_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is removed when the session ends."""
    path = f"{shared_folder(spark)}/windrow-llm/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` to the shared folder and reads it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: str | Column) -> Column:
    return F.translate(F.col(text) if isinstance(text, str) else text, UPPER, LOWER)


def unit_hash(key: Column) -> Column:
    """A number of (0, 1) decided by the text ``key``: 52 bits of its md5."""
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


#: Bits of the filters below; fixed, so they have a known size wherever they are broadcast.
FILTER_BITS = 1 << 23


def filter_place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame, key: str) -> np.ndarray:
    """Bits (in 64-bit words) at the hashes of the keys of ``ids``: 1 MB, however many there
    are. Once it is full it only lets more through."""
    at = filter_place(key)
    words = ids.select((at / 64).cast("int").alias("word"), (at % 64).cast("int").alias("bit"))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
    found = words.groupBy("word").agg(bits.alias("bits")).toPandas()
    filled = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    filled[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return filled


def passes(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places // 64] >> (places % 64)) & 1 == 1
