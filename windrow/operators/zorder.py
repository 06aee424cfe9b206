"""Z-values over any number of columns with any number of values.

63 bits are shared out: every column gets the bits its distinct values need, up to a cap that is
the same for all. Values are numbered range by range. The ranks of a column with few values are
joined to the rows; for one with many, the least value of each rank comes to the driver
(MAX_BOUNDS at most) and rows look theirs up, so they are not dealt out for it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.operators.quantiles import order_key
from windrow.operators.ranks import numbered
from windrow.session import COMPRESSION

Z_BITS = 63
#: About as many values are numbered together with other columns'.
FEW_VALUES = 50_000
#: Ranks of a column with more values that rows look up by binary search; of more, they are joined.
MAX_BOUNDS = 8_192
#: Rows of a range of a clustered folder at most: what a task sorts.
RANGE_ROWS = 2_000_000


def shared_bits(distinct: Sequence[int], budget: int = Z_BITS) -> list[int]:
    """Bits for columns with so many values: what each needs, below the largest common cap with
    which they fit the budget."""
    need = [max(n - 1, 0).bit_length() for n in distinct]
    cap = max((c for c in range(Z_BITS + 1) if sum(min(n, c) for n in need) <= budget), default=0)
    return [min(n, cap) for n in need]


def _sortable(df: DataFrame, column: str) -> tuple[Column, Column]:
    """A number and a text that sort as the column does; both null for null."""
    kind, value = df.schema[column].dataType, F.col(column)
    nothing = F.lit(None).cast("string")
    if isinstance(kind, T.StringType):
        return F.when(value.isNotNull(), F.lit(0).cast("long")), value
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return order_key(value), nothing
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long"), nothing
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value), nothing
    if isinstance(kind, (T.BooleanType, T.IntegralType)):
        return value.cast("long"), nothing
    raise TypeError(f"{column} has a type without an order: {kind.simpleString()}")


def with_ranks(df: DataFrame, columns: Sequence[str], budget: int = Z_BITS) -> tuple[DataFrame, dict[str, int]]:
    """Adds ``_rank_<column>`` for each column, and returns how many bits each rank has.

    A rank is the number of its value among the column's distinct values, or, if these are more
    than the bits can tell, the share of it: ranks have about as many values each. Null ranks 0.
    """
    keys = {c: _sortable(df, c) for c in columns}
    # As columns: a key made by calling Java cannot stand in a join's condition.
    df = df.withColumns({f"_{part}{i}": k for i, pair in enumerate(keys.values()) for part, k in zip("nt", pair, strict=True)})
    own = [F.struct(F.col(f"_n{i}").alias("number"), F.col(f"_t{i}").alias("text")) for i in range(len(columns))]
    # One row: columns with few values are numbered together, any other by itself.
    about = df.agg(*[F.approx_count_distinct(o).alias(f"a{i}") for i, o in enumerate(own)]).first()
    few = [i for i in range(len(columns)) if about[f"a{i}"] <= FEW_VALUES]
    tables, distinct = {}, [0] * len(columns)
    if few:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(i).alias("at"), own[i]["number"].alias("number"), own[i]["text"].alias("text")) for i in few
        ]))
        values = df.select(pairs.alias("_pair")).where("_pair.number is not null").distinct()
        values, _ = numbered(values.select("_pair.*"), ["at", "number", "text"], "_place")
        # One row for each column.
        known = {r["at"]: r["n"] for r in values.groupBy("at").agg(F.count("*").alias("n")).collect()}
        so_far = 0
        for i in few:
            distinct[i] = known.get(i, 0)
            tables[i] = values.where(F.col("at") == i).select("number", "text", (F.col("_place") - so_far).alias("_place"))
            so_far += distinct[i]
    for i in set(range(len(columns))) - set(few):
        values = df.select(F.col(f"_n{i}").alias("number"), F.col(f"_t{i}").alias("text")).where("number is not null")
        # Equal values meet in one range, so they are made one there.
        values = values.repartitionByRange("number", "text").dropDuplicates()
        tables[i], distinct[i] = numbered(values, ["number", "text"], "_place")
    bits = shared_bits(distinct, budget)
    for i, c in enumerate(columns):
        ranks = 2 ** bits[i]
        rank = F.col("_place") if distinct[i] <= ranks else F.floor(F.col("_place") * F.lit(float(ranks)) / distinct[i])
        ranked = tables[i].select(F.col("number").alias("_number"), F.col("text").alias("_text"), rank.cast("long").alias("_rank"))
        if i not in few and ranks <= MAX_BOUNDS:
            part, given = ("_text", f"_t{i}") if isinstance(df.schema[c].dataType, T.StringType) else ("_number", f"_n{i}")
            starts = ranked.groupBy("_rank").agg(F.min(part).alias("start")).orderBy("_rank").collect()
            df = df.withColumn(f"_rank_{c}", _bound_at_or_below(given, [r["start"] for r in starts]))
        else:
            same = (F.col(f"_n{i}") == F.col("_number")) & F.col(f"_t{i}").eqNullSafe(F.col("_text"))
            df = df.join(ranked, same, "left").withColumnRenamed("_rank", f"_rank_{c}").drop("_number", "_text")
        df = df.withColumn(f"_rank_{c}", F.coalesce(f"_rank_{c}", F.lit(0).cast("long")))
    return df.drop(*[f"_{part}{i}" for i in range(len(columns)) for part in "nt"]), dict(zip(columns, bits, strict=True))


def _bound_at_or_below(value: str, bounds: list) -> Column:
    """The place of the last of the ascending bounds at or below the value, by binary search."""
    steps = [1 << b for b in reversed(range((len(bounds) - 1).bit_length()))]
    if not steps:
        return F.when(F.col(value).isNotNull(), F.lit(0).cast("long"))
    # One literal, however many bounds.
    kind = "array<string>" if isinstance(bounds[0], str) else "array<bigint>"
    listed = F.from_json(F.lit(json.dumps(bounds)), kind)

    def further(low: Column, step: Column) -> Column:
        inside = low + step < F.lit(len(bounds))
        return F.when(inside & (F.element_at(listed, low + step + 1) <= F.col(value)), low + step).otherwise(low)

    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)
    return F.when(F.col(value).isNotNull(), found.cast("long"))


def interleaved(ranks: dict[str, int]) -> Column:
    """The bits of the ranks (column to number of bits) from the highest of each down."""
    places = sorted((top, i) for i, bits in enumerate(ranks.values()) for top in range(bits))
    names = list(ranks)
    z = F.lit(0).cast("long")
    for place, (top, i) in enumerate(places):
        bit = ranks[names[i]] - 1 - top
        taken = F.shiftright(F.col(names[i]), bit).bitwiseAND(F.lit(1).cast("long"))
        z = z.bitwiseOR(F.shiftleft(taken, len(places) - 1 - place))
    return z


def with_z(df: DataFrame, columns: Sequence[str], budget: int = Z_BITS) -> DataFrame:
    """Adds ``_z``, close for rows that are close in the columns, however many these are."""
    ranked, bits = with_ranks(df, columns, budget)
    names = {f"_rank_{c}": b for c, b in bits.items()}
    return ranked.withColumn("_z", interleaved(names)).drop(*names)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, partition_by: Sequence[str] = ()
) -> None:
    """Writes ``df`` as Parquet in ``files`` ranges of the Z-value, more if these would have more
    than RANGE_ROWS rows. A hash of the row comes last in the order, so that one Z-value that holds
    most of the rows is cut too."""
    files = max(files, -(-df.count() // RANGE_ROWS))
    spread = F.xxhash64(*df.columns)
    ordered = with_z(df, columns).withColumn("_spread", spread).repartitionByRange(files, *partition_by, "_z", "_spread")
    ordered.sortWithinPartitions(*partition_by, "_z").drop("_z", "_spread").write.option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
