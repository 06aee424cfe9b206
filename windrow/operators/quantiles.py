"""Exact quantiles of groups for any values, by radix selection.

A value becomes a 64-bit number in the same order. Four rounds each count the values of a group by
16 more bits, on the map side first, and keep the one count in which a wanted rank lies. So no
task ever holds or sorts a group: it sees at most 65,536 counts for each group and wanted rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.session import written_once

DIGIT_BITS, ROUNDS = 16, 4


def order_key(value: Column | str) -> Column:
    """A long for each double (or number that is one) in ascending order of the values: the bits of
    the double, those below the sign turned round for negative ones. Zeros are equal, NaN is
    above all others, null stays null."""
    number = F.col(value) if isinstance(value, str) else value
    text = F.call_function(
        "java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number.cast("double") + F.lit(0.0)
    )
    bits = F.when(number.isNotNull(), text.cast("long"))
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(2**63 - 1)))


def order_value(key: Column | str) -> Column:
    """The double of a key."""
    key = F.col(key) if isinstance(key, str) else key
    bits = F.when(key >= 0, key).otherwise(key.bitwiseXOR(F.lit(2**63 - 1)))
    text = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits)
    return F.when(key.isNotNull(), text.cast("double"))


def _prefix(rounds: int) -> Column:
    """The first ``rounds`` digits of the key."""
    return F.shiftright("_key", 64 - DIGIT_BITS * rounds) if rounds else F.lit(0).cast("long")


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(and_, pairs, F.lit(True))


def group_ranks(counts: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """The values at wanted ranks of groups.

    ``counts`` has the keys, ``_key`` (see ``order_key``) and ``_n``, how often the value stands
    there; rows may repeat. ``wanted`` has the keys, ``_name`` and ``_rank`` (from 0, below the
    group's size). Returns the keys, ``_name`` and ``_value``. Null keys are a group.
    """
    for done in range(ROUNDS):
        # The first round counts whole groups, so nothing is joined to the rows for it.
        if done == 0:
            part = counts.groupBy(*keys, _prefix(1).alias("_prefix")).agg(F.sum("_n").alias("_n"))
            part = wanted.alias("w").join(part.alias("c"), _same("w", "c", keys)).select("w.*", "c._prefix", "c._n")
        else:
            found = counts.select(*keys, _prefix(done).alias("_above"), _prefix(done + 1).alias("_prefix"), "_n")
            found = found.groupBy(*keys, "_above", "_prefix").agg(F.sum("_n").alias("_n"))
            part = wanted.alias("w").join(found.alias("c"), _same("w", "c", [*keys, "_above"])).select(
                *[f"w.{c}" for c in (*keys, "_name", "_rank")], "c._prefix", "c._n"
            )
        ordered = Window.partitionBy(*keys, "_name").orderBy("_prefix")
        upto = F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        placed = part.withColumn("_upto", upto).where(
            (F.col("_upto") - F.col("_n") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto"))
        )
        wanted = placed.select(
            *keys, "_name", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"), F.col("_prefix").alias("_above")
        )
    return wanted.select(*keys, "_name", order_value("_above").alias("_value"))


def group_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, quantiles: Mapping[str, tuple[float, str]]
) -> DataFrame:
    """The keys and one column for each quantile (name to share and method) of ``column``.

    The method ``median`` averages the two values around the share's place, ``nearest`` takes
    the value at rank ``round((n - 1) * share)``. Nulls do not count; a group without values has
    nulls. Values are counted before anything moves, and counts are dealt out by group *and* value,
    so a group that holds most of the rows is spread over all tasks.
    """
    keyed = df.select(*keys, order_key(column).alias("_key"))
    counts = written_once(keyed.groupBy(*keys, "_key").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    sizes = counts.groupBy(*keys).agg(F.sum(F.when(F.col("_key").isNotNull(), F.col("_n")).otherwise(0)).alias("_size"))
    ranks = []
    for name, (share, method) in quantiles.items():
        place = (F.col("_size") - 1) * F.lit(share)
        ends = [F.round(place)] * 2 if method == "nearest" else [F.floor(place), F.ceil(place)]
        for end, rank in zip(("low", "high"), ends, strict=True):
            ranks.append(F.struct(F.lit(f"{name}.{end}").alias("_name"), rank.cast("long").alias("_rank")))
    known = sizes.where("_size > 0").select(*keys, F.explode(F.array(*ranks)).alias("_wanted"))
    wanted = known.select(*keys, "_wanted.*")
    values = group_ranks(counts.where("_key is not null"), keys, wanted)

    def at(name: str) -> Column:
        low, high = (F.max(F.when(F.col("_name") == f"{name}.{end}", F.col("_value"))) for end in ("low", "high"))
        return F.when(low == high, low).otherwise((low + high) / 2).alias(name)

    found = values.groupBy(*keys).agg(*[at(name) for name in quantiles])
    joined = sizes.alias("s").join(found.alias("f"), _same("s", "f", keys), "left")
    return joined.select(*[f"s.{k}" for k in keys], *[f"f.{name}" for name in quantiles])
