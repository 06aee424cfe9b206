"""Top-k reports, samples and holdout splits.

Samples and splits are drawn by the md5 of a key, ties by the key itself, so they depend on the
rows alone: not on how Spark happened to partition them, nor on what the keys look like.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.schemas import SEED, TEST_SIZE
from windrow.session import written_once

#: Leading hex digits of the key's hash that form the histogram of ``_boundary``: 16**4 buckets.
PREFIX_DIGITS = 4


def with_flight_id(df: DataFrame, columns: Sequence[str], seed: int = SEED) -> DataFrame:
    """Adds ``flight_id``: md5 of the seed and the columns that identify a row."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.withColumn("flight_id", F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)))


def key_hash(key: str) -> Column:
    """32 hex digits that spread evenly whatever the keys are; a null key counts as empty."""
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order (``TakeOrderedAndProject``); for small ``k``."""
    return df.orderBy(*order).limit(k)


def _boundary(df: DataFrame, key: str, strata: Sequence[str], target: Column) -> DataFrame:
    """Per stratum, the hash prefix in which the row of the ``target``-th lowest hash lies.

    One narrow aggregation counts rows per prefix; at most 16**4 counts per stratum
    remain for the running total, however many rows there are. ``need`` is how many rows of
    the boundary prefix still belong below the cut.
    """
    prefix = F.substring(key_hash(key), 1, PREFIX_DIGITS).alias("_prefix")
    counts = df.groupBy(*strata, prefix).agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(*strata).orderBy("_prefix")
    running = counts.select(
        "*",
        F.sum("_n").over(ordered).alias("_upto"),
        F.sum("_n")
        .over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("_total"),
    ).withColumn("_target", target)
    return running.where(
        (F.col("_upto") - F.col("_n") < F.col("_target")) & (F.col("_target") <= F.col("_upto"))
    ).select(*strata, "_prefix", (F.col("_target") - F.col("_upto") + F.col("_n")).alias("_need"))


def sample_lowest(df: DataFrame, n: int, key: str = "flight_id") -> DataFrame:
    """The ``n`` rows whose keys have the lowest hashes: a deterministic sample of fixed size.

    A plain sort and limit would send ``n`` rows of every scan task to one task. The prefix
    histogram first cuts the input to ``n`` rows plus one bucket in 65,536.
    """
    target = F.least(F.lit(n), F.col("_total"))
    last = _boundary(df, key, [], target).agg(F.max("_prefix"))
    near = df.where(F.substring(key_hash(key), 1, PREFIX_DIGITS) <= last.scalar())
    return near.orderBy(key_hash(key), key).limit(n)


def split_hash(
    df: DataFrame, test_size: float = TEST_SIZE, key: str = "flight_id"
) -> DataFrame:
    """Adds ``is_test``: true for about ``test_size`` of the keys; no shuffle.

    The trailing digits of the key's hash decide, so the split is independent of
    ``sample_lowest``, which goes by the leading ones.
    """
    threshold = format(min(round(test_size * 16**8), 16**8 - 1), "08x")
    return df.withColumn("is_test", F.substring(key_hash(key), -8, 8) < threshold)


def split_stratified(
    df: DataFrame, label: str, test_size: float = TEST_SIZE, key: str = "flight_id"
) -> DataFrame:
    """Adds ``is_test`` so that each class gives exactly ``round(test_size * rows)`` rows.

    Ranking a whole class would put it in one task. Instead the prefix histogram finds each
    class's boundary bucket (about one row in 65,536), only that bucket is ranked, and the
    resulting cut-off (one row per class) is written and joined back: Spark finds it small from
    its files before it plans the join, and does not deal the rows out by class.
    Rows of one class that share a key share their side unless the cut falls among them.
    """
    target = F.round(F.col("_total") * F.lit(test_size)).cast("long")
    boundary = _boundary(df, key, [label], target)
    hashed = key_hash(key).alias("_hash")
    near = df.select(label, key, hashed, F.substring(key_hash(key), 1, PREFIX_DIGITS).alias("_prefix"))
    near = near.join(written_once(boundary, "boundary"), [label, "_prefix"])
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_hash", key))
    cut = near.withColumn("_rank", rank).where(F.col("_rank") == F.col("_need"))
    cut = written_once(cut.select(label, F.struct("_hash", F.col(key).alias("_key")).alias("_cut")), "cuts")
    below = F.struct(key_hash(key).alias("_hash"), F.col(key).alias("_key")) <= F.col("_cut")
    return (
        df.join(cut, label, "left").withColumn("is_test", F.coalesce(below, F.lit(False))).drop("_cut")
    )
