"""ML feature tables with their two targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import columns as fn
from windrow.operators.cleaning import filter_year, select_available
from windrow.operators.selection import sample_lowest
from windrow.schemas import DELAY_THRESHOLD_MINUTES, FEATURE_COLUMNS, SIMPLE_FEATURE_COLUMNS


def with_targets(df: DataFrame, threshold: float = DELAY_THRESHOLD_MINUTES) -> DataFrame:
    """Arrival delay as the regression target, late or not (1/0) as the class."""
    return df.withColumns(
        {
            "target_arrival_delay": F.col("ArrDelay"),
            "target_is_delayed": fn.is_late(threshold).cast("int"),
        }
    )


def features_full(silver: DataFrame, threshold: float = DELAY_THRESHOLD_MINUTES) -> DataFrame:
    """Feature table from silver: known delays, available columns, both targets."""
    rows = select_available(silver, FEATURE_COLUMNS).where(
        F.col("ArrDelay").isNotNull() & F.col("DepDelay").isNotNull()
    )
    return with_targets(rows, threshold)


def features_simple(
    raw: DataFrame,
    limit: int | None = None,
    year: int | None = 2024,
    threshold: float = DELAY_THRESHOLD_MINUTES,
) -> DataFrame:
    """Feature table from raw records: hour, season and route inline, every qualifying row.

    With a ``limit`` it is a sample of that size, taken after the null filter.
    """
    rows = raw if year is None else filter_year(raw, year)
    rows = rows.where(
        F.col("ArrDelay").isNotNull() & F.col("DepDelay").isNotNull() & (F.col("Distance") > 0)
    )
    if limit is not None:
        rows = sample_lowest(rows, limit)
    rows = rows.withColumns(
        {
            "DEP_HOUR": fn.hour_of("CRSDepTime"),
            "SEASON": fn.season("Month", unknown="Fall"),
            "ROUTE": fn.route(),
        }
    )
    return with_targets(select_available(rows, SIMPLE_FEATURE_COLUMNS), threshold)


def feature_summary(features: DataFrame) -> DataFrame:
    """Average delay and delay rate of a feature table, in one row."""
    return features.agg(
        F.avg("target_arrival_delay").alias("avg_delay"),
        F.avg("target_is_delayed").alias("delay_rate"),
    )
