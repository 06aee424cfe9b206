"""Compaction of Parquet folders without a shuffle.

Files are packed by size, partition by partition, and each pack is read and written by one task:
rows go from small files into large ones without being dealt out anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrow.schemas import TARGET_FILE_BYTES
from windrow.session import COMPRESSION, unsorted_writes

#: Packs that one job reads: each is a scan of its own in the plan.
PACKS_AT_ONCE = 500
#: Whether Spark takes a union of frames with one partition each as one partition.
_UNION = "spark.sql.unionOutputPartitioning"


def data_files(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    """Path and length of every Parquet file below the folders; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return reader.load(folders).select("path", "length")


def packs(
    files: DataFrame, target_bytes: int = TARGET_FILE_BYTES, partition: Column | None = None
) -> list[list[str]]:
    """Paths of files to be written as one, from ``path`` and ``length``. A file's ``partition`` is
    the folder it stands in unless given. Files of a partition are laid end to end and cut every
    ``target_bytes``.

    The driver gets the paths, which it listed to begin with.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1) if partition is None else partition
    placed = files.withColumn("_folder", folder)
    before = Window.partitionBy("_folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_pack", F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target_bytes))
    grouped = placed.groupBy("_folder", "_pack").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [r["paths"] for r in grouped.orderBy("_folder", "_pack").collect()]


@contextmanager
def one_task_a_pack(spark: SparkSession) -> Iterator[None]:
    """Within it, a union of packs that is run keeps one task for each of them, and a pack, which
    is of one partition, is written as it is read, without a sort."""
    before = spark.conf.get(_UNION, None)
    spark.conf.set(_UNION, "false")
    try:
        with unsorted_writes(spark):
            yield
    finally:
        spark.conf.unset(_UNION) if before is None else spark.conf.set(_UNION, before)


def read_packed(packed: Sequence[Sequence[str]], load: Callable[[list[str]], DataFrame]) -> DataFrame:
    """The rows of all packs, to be run inside ``one_task_a_pack``: one task for a pack of several
    files. A file alone is left to Spark, which splits it if it is large."""
    frames = [load(list(p)) if len(p) == 1 else load(list(p)).coalesce(1) for p in packed]
    return reduce(DataFrame.unionByName, frames)


def needy(files: DataFrame, target_bytes: int) -> DataFrame:
    """The files of folders with at least two files below half the target."""
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    small = F.count_if(F.col("length") < target_bytes / 2).over(Window.partitionBy(folder))
    return files.withColumn("_small", small).where("_small > 1").drop("_small")


def compact_folder(
    spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES, packs_at_once: int = PACKS_AT_ONCE,
) -> int:
    """Writes the rows of a Parquet folder to a new one in files of about ``target_bytes``, and
    returns the number of packs. Columns and types are those of ``source`` as a whole; rows of one
    partition stay together, and one that holds most of the rows is cut into many packs. An empty
    folder makes one with no rows.
    """
    whole = spark.read.option("mergeSchema", True).parquet(source)
    reader = spark.read.option("basePath", source).schema(whole.schema)
    packed = packs(data_files(spark, source), target_bytes)
    if not packed:
        whole.limit(0).write.partitionBy(*partition_by).parquet(target)
    for at in range(0, len(packed), packs_at_once):
        rows = read_packed(packed[at : at + packs_at_once], lambda paths: reader.parquet(*paths))
        with one_task_a_pack(spark):
            rows.write.mode("append").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(target)
    return len(packed)
