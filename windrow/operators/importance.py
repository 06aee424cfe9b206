"""Permutation importance: how much worse a model scores when one feature is shuffled."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.schemas import SEED
from windrow.session import written_once

#: Leading hex digits of the hash that cut the order into parts: 16**3 of them.
PART_DIGITS = 3


def shuffled(
    df: DataFrame, feature: str, key: str = "flight_id", seed: int = SEED, stored: bool = False
) -> DataFrame:
    """``df`` with the values of one column moved round among the rows.

    Rows are ordered by a hash of seed, column and key, ties by the key; each takes the value of
    the row before it and the first that of the last. Keys must differ: rows that share one are
    left out, and the row after them stands there once for each of their values.

    The order is cut at the leading digits of the hash, so rows are dealt out once, evenly, with
    no more columns than are used later; each part starts with what the part before it ends with.
    ``df`` is read several times, so it is written first unless it is ``stored`` already.
    """
    df = df if stored else written_once(df, "shuffled")
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(feature), F.col(key).cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    cut = df.withColumn("_part", F.substring(F.md5(text), 1, PART_DIGITS))
    # At most one row for each part; the hashes that share the 15 digits of the last are few.
    tops = written_once(cut.groupBy("_part").agg(F.max(number).alias("_top")), "tops").select(F.col("_part").alias("_p"), "_top")
    near = cut.join(tops, (F.col("_part") == F.col("_p")) & (number == F.col("_top")))
    near = near.select("_part", F.md5(text).alias("_hash"), F.col(key).alias("_key"), F.struct(F.col(feature).alias("v")).alias("_value"))
    last = near.groupBy("_part", "_hash", "_key").agg(F.collect_list("_value").alias("_values"))
    last = written_once(last.groupBy("_part").agg(F.max_by("_values", F.struct("_hash", "_key")).alias("_before")), "ends")
    # Of at most 16**PART_DIGITS rows.
    parts = Window.partitionBy(F.lit(0)).orderBy("_part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_before").over(parts), F.last("_before").over(whole))
    first = written_once(last.select(F.col("_part").alias("_p"), before.alias("_before")), "starts")

    placed = cut.repartition("_part").withColumn("_hash", F.md5(text))
    mine = F.collect_list(F.struct(F.col(feature).alias("v"))).over(Window.partitionBy("_part", "_hash", key))
    placed = placed.withColumn("_values", mine)
    placed = placed.withColumn("_lag", F.lag("_values").over(Window.partitionBy("_part").orderBy("_hash", key)))
    placed = placed.where(F.size("_values") == 1).join(first, F.col("_part") == F.col("_p"), "left")
    moved = placed.withColumn("_moved", F.explode(F.coalesce("_lag", "_before")))
    return moved.select(*[F.col("_moved.v").alias(feature) if c == feature else F.col(c) for c in df.columns])


def permutation_importance(
    df: DataFrame, features: Sequence[str], predict: Callable[[DataFrame], DataFrame], loss: Column,
    key: str = "flight_id", seed: int = SEED,
) -> DataFrame:
    """feature, score, shuffled_score and importance, the first being ``loss`` (an aggregate over
    what ``predict`` returns) on ``df`` and the second that on ``df`` with the feature shuffled.

    A higher loss is worse, so importances are high for features a model relies on. Each feature
    is shuffled in a job of its own; no row comes to the driver. Rows are written once for all of
    them.
    """
    spark = df.sparkSession
    df = written_once(df, "rows")
    score = predict(df).agg(loss).first()[0]
    rows = []
    for feature in features:
        worse = predict(shuffled(df, feature, key, seed, stored=True)).agg(loss).first()[0]
        rows.append((feature, score, worse, None if worse is None else worse - score))
    return spark.createDataFrame(
        rows, "feature string, score double, shuffled_score double, importance double"
    )
