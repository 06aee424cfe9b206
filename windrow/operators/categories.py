"""Category values as numbers: each value's place in its column, or a bin by the target.

Values are numbered by running totals over ranges and joined to the rows, so a column may have
any number of them: they are never listed on the driver or gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.util import (
    DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.ranks import with_running_total
from windrow.session import written_once


@dataclass(frozen=True)
class Dictionary:
    """``table`` has feature, value and index (from 0, by ascending value); ``sizes`` how many
    values each feature has."""

    table: DataFrame
    sizes: dict[str, int]

    def of(self, feature: str) -> DataFrame:
        return self.table.where(F.col("feature") == feature).select("value", "index")


def dictionary(df: DataFrame, columns: Sequence[str]) -> Dictionary:
    """Numbers the values of ``columns`` (as texts, nulls left out) in one pass over ``df``."""
    spark = df.sparkSession
    if not columns:
        return Dictionary(spark.createDataFrame([], "feature string, value string, index bigint"), {})
    pairs = F.explode(
        F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    )
    values = df.select(pairs.alias("_pair")).where("_pair.value is not null").distinct()
    numbered = with_running_total(values.withColumn("_one", F.lit(1)), "_pair", "_one", "_upto")
    # One row for each feature.
    counts = {r["at"]: r["n"] for r in numbered.groupBy("_pair.at").agg(F.count("*").alias("n")).collect()}
    sizes = [counts.get(i, 0) for i in range(len(columns))]
    before = F.array(*[F.lit(sum(sizes[:i])) for i in range(len(columns))])
    names = F.array(*map(F.lit, columns))
    place = F.col("_pair.at") + 1
    table = numbered.select(
        F.element_at(names, place).alias("feature"), F.col("_pair.value").alias("value"),
        (F.col("_upto") - 1 - F.element_at(before, place)).alias("index"),
    )
    return Dictionary(table, dict(zip(columns, sizes, strict=True)))


def with_indexes(df: DataFrame, found: Dictionary, names: dict[str, str]) -> DataFrame:
    """Adds for each feature of ``names`` the column of that name: the value's number, null for a
    null or a value that the dictionary does not have."""
    for feature, name in names.items():
        numbers = found.of(feature).select(F.col("value").alias("_value"), F.col("index").alias(name))
        df = df.join(numbers, F.col(feature).cast("string") == F.col("_value"), "left").drop("_value")
    return df


class CategoryBins(Transformer, MLReadable, MLWritable):
    """Adds ``<feature>_bin`` for each feature: a number that orders its values by how the target
    behaves in them, so that a tree splits it like any number. ``table`` has feature, value and
    bin; a value that it lacks gets the bin in which the average row stands (``usual``)."""

    def __init__(self, table: DataFrame, usual: dict[str, float]):
        super().__init__()
        self.table, self.usual = table, usual

    @property
    def columns(self) -> list[str]:
        return [f"{c}_bin" for c in self.usual]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for feature, usual in self.usual.items():
            own = self.table.where(F.col("feature") == feature).select(
                F.col("value").alias("_value"), F.col("bin").alias("_bin")
            )
            dataset = dataset.join(own, F.col(feature).cast("string") == F.col("_value"), "left")
            dataset = dataset.withColumn(f"{feature}_bin", F.coalesce("_bin", F.lit(usual))).drop("_value", "_bin")
        return dataset

    def write(self) -> MLWriter:
        return _BinsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BinsReader()


class _BinsWriter(MLWriter):
    def __init__(self, bins: CategoryBins):
        super().__init__()
        self.bins = bins

    def saveImpl(self, path: str) -> None:
        spark = self.bins.table.sparkSession
        DefaultParamsWriter.saveMetadata(self.bins, path, spark, extraMetadata={"usual": self.bins.usual})
        self.bins.table.write.parquet(f"{path}/bins")


class _BinsReader(MLReader):
    def load(self, path: str) -> CategoryBins:
        spark = SparkSession.active()
        usual = DefaultParamsReader.loadMetadata(path, spark)["usual"]
        return CategoryBins(spark.read.parquet(f"{path}/bins"), usual)


def fit_bins(df: DataFrame, columns: Sequence[str], target: str, at_most: int = 256) -> tuple[CategoryBins, int]:
    """Orders the values of each column by the mean of ``target`` (ties by value) and numbers them;
    of more than ``at_most`` values, neighbours share a bin so that bins hold about equally many
    rows. Returns the bins and the largest number of bins of a column.

    For a number or a 0/1 class as target, the best split of a category into two sets of values is
    a cut in that order, so a tree loses nothing to trying all sets, up to the size of the bins.
    """
    spark = df.sparkSession
    if not columns:
        return CategoryBins(spark.createDataFrame([], "feature string, value string, bin double"), {}), 0
    pairs = F.explode(
        F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    )
    rows = df.select(pairs.alias("_pair"), F.col(target).cast("double").alias("_target"))
    means = rows.where("_pair.value is not null").groupBy("_pair.at", "_pair.value").agg(
        F.count("*").alias("n"), F.avg("_target").alias("mean")
    )
    means = written_once(means, "category-means")
    # One row for each feature.
    known = {r["at"]: r for r in means.groupBy("at").agg(
        F.count("*").alias("size"), F.sum("n").alias("rows"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("mean")
    ).collect()}
    per_feature = [known.get(i) for i in range(len(columns))]
    fits = [r is None or r["size"] <= at_most for r in per_feature]
    whole = [0 if r is None else r["size"] if fit else r["rows"] for r, fit in zip(per_feature, fits, strict=True)]

    def by_feature(values: Sequence) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("at") + 1)

    amount = F.when(by_feature(fits), F.lit(1)).otherwise(F.col("n"))
    ordered = means.select("at", "value", "n", "mean", F.struct("at", "mean", "value").alias("_order"), amount.alias("_amount"))
    placed = with_running_total(ordered, "_order", "_amount", "_upto")
    before = F.col("_upto") - F.col("_amount") - by_feature([sum(whole[:i]) for i in range(len(columns))])
    share = F.floor(before * F.lit(at_most) / by_feature([max(w, 1) for w in whole]))
    binned = placed.select(
        by_feature(list(columns)).alias("feature"), "value",
        F.when(by_feature(fits), before).otherwise(share).cast("double").alias("bin"), "at", "mean",
    )
    average = by_feature([0.0 if r is None else r["mean"] for r in per_feature])
    usual = {r["feature"]: r["bin"] for r in binned.where(F.col("mean") <= average).groupBy("feature").agg(F.max("bin").alias("bin")).collect()}
    bins = CategoryBins(binned.select("feature", "value", "bin"), {c: usual.get(c, 0.0) for c in columns})
    return bins, max(min(r["size"], at_most) if r else 0 for r in per_feature)
