"""Reports over silver and over the KPI tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions import columns as fn
from windrow.functions.exact import exact_mean
from windrow.operators.kpis import kpi
from windrow.operators.ranks import with_running_total
from windrow.operators.selection import top_k
from windrow.session import written_once


def carrier_month_topk(
    silver: DataFrame, year: int, carriers: Sequence[str], k: int = 10
) -> DataFrame:
    """Carrier-months with the highest average delay among late arrivals of a year."""
    late = silver.where(
        (F.col("Year") == year) & F.col("AIRLINE").isin(*carriers) & (F.col("ArrDelay") > 0)
    )
    months = _carrier_months(late, with_median=True)
    return top_k(months, [F.desc_nulls_first("avg_delay"), "AIRLINE", "Month"], k)


def carrier_month_rank(silver: DataFrame, year: int, carriers: Sequence[str]) -> DataFrame:
    """All carrier-months of a year, highest average delay first."""
    rows = silver.where((F.col("Year") == year) & F.col("AIRLINE").isin(*carriers))
    months = _carrier_months(rows, with_median=False)
    return months.orderBy(F.desc_nulls_first("avg_delay"))


def _carrier_months(rows: DataFrame, with_median: bool) -> DataFrame:
    names = {"total_flights": "flight_count", "avg_arrival_delay": "avg_delay"}
    if with_median:
        names["median_arrival_delay"] = "median_delay"
    return kpi(rows, ["AIRLINE", "Month"], list(names)).withColumnsRenamed(names)


def exact_means(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Means per group, equal to the last bit however the rows are partitioned."""
    return df.groupBy(*keys).agg(*[exact_mean(c).alias(c) for c in columns])


def hourly_profile(temporal: DataFrame) -> DataFrame:
    """Unweighted mean of the average delays per departure hour."""
    return temporal.groupBy("DEP_HOUR").agg(
        F.round(F.avg("avg_arrival_delay"), 6).alias("avg_arrival_delay")
    )


def season_profile(temporal: DataFrame) -> DataFrame:
    """Unweighted mean of the delay rates per season."""
    return temporal.groupBy("SEASON").agg(F.round(F.avg("delay_rate"), 6).alias("delay_rate"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, nulls, mean, deviation, extremes and nearest-rank quartiles, in one row.

    Rows are counted per value first; everything else is read off those counts, whose running
    total is worked out by ranges of the value.
    """
    counts = written_once(
        df.groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "values"
    )
    known = counts.where(F.col("_v").isNotNull())
    first = known.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
        fn.ratio(F.sum(F.col("_v") * F.col("_n")), F.sum("_n")).alias("mean"),
    ).first()
    total, mean = first["n"], F.lit(first["mean"]).cast("double")
    ranked = with_running_total(known, "_v", "_n", "_upto")

    def quartile(q: float) -> Column:
        rank = F.round(F.lit(total - 1) * F.lit(q))
        here = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(here, F.col("_v")))

    nulls = counts.where(F.col("_v").isNull()).agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    spread = F.sum(F.col("_n") * F.pow(F.col("_v") - mean, 2))
    return ranked.agg(
        F.lit(total).cast("long").alias("count"),
        F.lit(nulls).cast("long").alias("null_count"),
        F.round(mean, 6).alias("mean"),
        F.round(F.sqrt(fn.ratio(spread, F.lit(total - 1))), 6).alias("std"),
        F.min("_v").alias("min"),
        quartile(0.25).alias("q25"),
        quartile(0.5).alias("q50"),
        quartile(0.75).alias("q75"),
        F.max("_v").alias("max"),
    )


def worst_best(table: DataFrame, entity: str) -> DataFrame:
    """The entity-month rows with the highest and the lowest average delay.

    A month without any known delay sorts first either way, as nulls do in the sorts of the
    KPI tables; ties go to the highest (worst) or lowest (best) entity and month.
    """
    row = F.struct(F.col(entity).alias("entity"), "Month", "avg_arrival_delay")
    delay = F.col("avg_arrival_delay")
    worst = F.max_by(row, F.struct(delay.isNull(), delay, F.col(entity), F.col("Month")))
    best = F.min_by(row, F.struct(delay.isNotNull(), delay, F.col(entity), F.col("Month")))
    ends = table.agg(worst.alias("worst"), best.alias("best")).where("worst IS NOT NULL")
    return ends.select(
        F.inline(
            F.array(
                F.struct(F.lit("worst").alias("rank"), "worst.*"),
                F.struct(F.lit("best").alias("rank"), "best.*"),
            )
        )
    )


def worst_hours(temporal: DataFrame, keys: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` temporal groups with the highest average delay."""
    worst = top_k(temporal, [F.desc_nulls_first("avg_arrival_delay"), *keys], k)
    return worst.select(*keys, "avg_arrival_delay", "delay_rate")


def result_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each result, one row per table."""
    sizes = None
    for name, table in tables.items():
        size = table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(table.columns)).alias("column_count"),
        )
        sizes = size if sizes is None else sizes.unionByName(size)
    return sizes
