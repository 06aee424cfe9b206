"""Running totals over a sorted table without gathering it in one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.session import written_once


def with_running_total(df: DataFrame, order: str, amount: str, total: str) -> DataFrame:
    """Adds ``total``: the sum of ``amount`` over all rows up to and with this one in ``order``.

    Rows are cut into ranges of ``order`` and written once; totals run within each range, and
    each range starts at the sum of those before it (one number for each comes to the driver).
    ``order`` must not repeat or be null.
    """
    ranged = df.repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    ranged = written_once(ranged, "ranges")
    sums = {r["_range"]: r["s"] for r in ranged.groupBy("_range").agg(F.sum(amount).alias("s")).collect()}
    starts, so_far = [], 0
    for number in range(max(sums, default=-1) + 1):
        starts.append(so_far)
        so_far += sums.get(number) or 0
    before = F.element_at(F.array(*map(F.lit, starts or [0])), F.col("_range") + 1)
    inside = F.sum(amount).over(Window.partitionBy("_range").orderBy(order))
    return ranged.withColumn(total, inside + before).drop("_range")


def numbered(df: DataFrame, order: Sequence[str], place: str) -> tuple[DataFrame, int]:
    """``df`` with each row's place in ``order`` (from 0), and the number of its rows.

    As ``with_running_total`` of ones, but rows are numbered as they are written, range by range,
    so they are dealt out only once. ``order`` must not repeat or be null.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits are the number of the partition, the lower ones that of the row in it.
    ranged = written_once(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).alias("_range")
    sizes = {r["_range"]: r["n"] for r in ranged.groupBy(part).agg(F.count("*").alias("n")).collect()}
    starts = [0, *accumulate(sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1))]
    before = F.element_at(F.array(*map(F.lit, starts)), F.shiftright("_at", 33).cast("int") + 1)
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn(place, inside + before).drop("_at"), starts[-1]
