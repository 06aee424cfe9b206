"""Weighted rendezvous hashing of stable record keys over shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.llm.common import stored, unit_hash


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the least ``-ln(u) / weight``, where u is a hash of key and shard number.

    A shard gets keys in proportion to its weight; a shard that is added (or grows) takes keys
    only into itself, one that is removed (or shrinks) gives up only its own. Weights of zero
    take no keys. Ties go to the smaller shard. A null key counts as the empty text.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    text = F.coalesce(key.cast("string"), F.lit(""))
    draws = [
        F.struct(
            (-F.log(unit_hash(F.concat(text, F.lit(f":{shard}")))) / F.lit(float(weight))).alias("draw"),
            F.lit(shard).alias("shard"),
        )
        for shard, weight in enumerate(weights)
        if weight > 0
    ]
    best = draws[0] if len(draws) == 1 else F.least(*draws)
    return best["shard"]


def number_rows(rows: DataFrame, group: str, slot: str) -> DataFrame:
    """Numbers the rows of each group from 0 without gaps.

    The rows are stored with the task that made them and their place in it; rows are then
    numbered within their task and shifted by what earlier tasks hold. Nothing gets more rows
    of a group together than one task made, so a hot group does no harm.
    """
    names = rows.columns
    placed = rows.select("*", F.monotonically_increasing_id().alias("_at"))
    at = stored(placed, "placed").select("*", F.shiftright("_at", 33).alias("_task"))
    counts = at.groupBy(group, "_task").agg(F.count("*").alias("_n"))
    in_task = Window.partitionBy(group, "_task").orderBy("_at")
    before = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        group, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    numbered = at.withColumn("_local", F.row_number().over(in_task).cast("long") - 1)
    joined = numbered.join(shifts, [group, "_task"])
    return joined.withColumn(slot, F.col("_local") + F.col("_shift")).select(*names, slot)


def shard_documents(
    docs: DataFrame, weights: Sequence[float], added_weight: float = 1.0,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Assigns every row to a shard by its id alone, and gives it a slot in that shard.

    Returns id, size (UTF-8 bytes of the text, null: none, plus 1), text_crc32, law, shard,
    slot, grown_shard (the shard once one more of ``added_weight`` exists). Rows with the same
    id go to the same shard, and repeated rows get slots of their own. A null id is the key
    ''; a null text has the crc32 of no bytes, 0. No rows give no rows. Other columns of
    ``docs`` are not read.

    One pass over the texts; only the short rows with the digests are stored and shuffled.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    key = F.col(id_column)
    short = docs.select(
        key,
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(key, weights).cast(T.IntegerType()).alias("shard"),
        rendezvous_shard(key, [*weights, added_weight]).cast(T.IntegerType()).alias("grown_shard"),
    )
    numbered = number_rows(short, "shard", "slot")
    return numbered.select(
        id_column, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
