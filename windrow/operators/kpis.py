"""Grouped delay KPIs with exact medians and quantiles.

Every mean is kept as a sum and a count until the end, so the same finishing projection
serves one aggregation or two. Exact quantiles take two: rows are first counted per group
*and delay value*, which Spark combines on the map side and spreads over tasks by value, so
a group holding a third of all rows is just a few hundred counts (delays are whole minutes;
silver keeps 601 of them). A running total over those counts then finds the wanted ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions import columns as fn
from windrow.operators.quantiles import group_quantiles
from windrow.operators.selection import key_hash
from windrow.schemas import CARRIER, DELAY_THRESHOLD_MINUTES

DELAY = "ArrDelay"

#: Mean measures: output name and input column.
MEANS = {
    "avg_arrival_delay": "ArrDelay",
    "avg_departure_delay": "DepDelay",
    "avg_distance": "Distance",
    "avg_air_time": "AirTime",
}


@dataclass(frozen=True)
class Quantile:
    """An exact order statistic of the arrival delay.

    ``median`` averages the middle two values; ``nearest`` takes the value at rank
    ``round((n - 1) * q)``.
    """

    q: float
    method: str

    def ranks(self, n: Column) -> list[Column]:
        position = (n - 1) * F.lit(self.q)
        if self.method == "nearest":
            return [F.round(position)]
        return [F.floor(position), F.ceil(position)]


QUANTILES = {
    "median_arrival_delay": Quantile(0.5, "median"),
    "p95_arrival_delay": Quantile(0.95, "nearest"),
}

#: Measures of each KPI table, in column order.
AIRPORT = [
    "total_flights", "avg_arrival_delay", "avg_departure_delay", "median_arrival_delay",
    "p95_arrival_delay", "delayed_flights", "delay_rate", "avg_distance", "avg_air_time",
]
AIRLINE = [
    "total_flights", "avg_arrival_delay", "avg_departure_delay", "median_arrival_delay",
    "delayed_flights", "delay_rate", "avg_distance", "avg_air_time", "unique_routes",
]
TEMPORAL = [
    "total_flights", "avg_arrival_delay", "avg_departure_delay", "delayed_flights",
    "delay_rate", "avg_distance",
]
ROUTE = [
    "total_flights", "avg_arrival_delay", "avg_departure_delay", "delayed_flights",
    "delay_rate", "distance", "avg_air_time",
]
AIRPORT_SIMPLE = [
    "total_flights", "avg_arrival_delay", "avg_departure_delay", "median_arrival_delay",
    "delayed_flights", "delay_rate", "avg_distance",
]
AIRLINE_SIMPLE = TEMPORAL
TEMPORAL_SIMPLE = ["total_flights", "avg_arrival_delay", "delayed_flights", "delay_rate"]


def kpi(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    min_flights: int = 0,
    threshold: float = DELAY_THRESHOLD_MINUTES,
    fractional: bool = False,
) -> DataFrame:
    """One row per key combination with the named measures; groups below ``min_flights`` go.

    With ``fractional`` the delays may be any numbers: their quantiles are then found by radix
    selection instead of by ranking a group's distinct delays. The result is the same.
    """
    partials = _partials(measures, threshold, "flight_id" in df.columns)
    if fractional and any(m in QUANTILES for m in measures):
        table = _selected(df, keys, measures, partials)
    elif any(m in QUANTILES for m in measures):
        table = _ranked(df, keys, measures, partials, threshold)
    else:
        table = df.groupBy(*keys).agg(*[c.alias(n) for n, c in partials.items()])
    if min_flights > 0:
        table = table.where(F.col("_rows") >= min_flights)
    return table.select(*keys, *[_finish(m).alias(m) for m in measures])


def _partials(measures: Sequence[str], threshold: float, keyed: bool) -> dict[str, Column]:
    partials = {"_rows": F.count(F.lit(1))}
    averaged = {MEANS[m] for m in measures if m in MEANS}
    for column in sorted(averaged):
        partials[f"_sum_{column}"] = F.sum(column)
        partials[f"_n_{column}"] = F.count(column)
    if {"delayed_flights", "delay_rate"} & set(measures):
        partials["_late"] = F.count_if(fn.is_late(threshold, DELAY))
        partials[f"_n_{DELAY}"] = F.count(DELAY)
    if "distance" in measures:
        # "First" has no meaning once rows are shuffled: take the row whose key (or, without
        # one, whose values) has the lowest hash, its first 124 bits as a number: a text would
        # force a sort-based aggregation of the raw rows.
        digits = key_hash("flight_id") if keyed else F.md5(F.to_json(F.struct("*")))
        high, low = (
            F.conv(F.substring(digits, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)
        )
        lowest = high * F.lit(2**60).cast("decimal(20,0)") + F.floor(low / 16).cast("decimal(20,0)")
        partials["_distance"] = F.min_by("Distance", lowest.cast("decimal(38,0)"))
    return partials


def _selected(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], partials: dict[str, Column]
) -> DataFrame:
    """Partials per group with a column ``_<name>`` per quantile, from radix selection."""
    aggregates = [c.alias(n) for n, c in partials.items()]
    if "unique_routes" in measures:
        # A null route counts once, as in the grouping sets of ``_ranked``.
        by_route = df.groupBy(*keys, "ROUTE").agg(F.lit(1).alias("_one")).groupBy(*keys).agg(F.count("*").alias("_routes"))
        table = _with(df.groupBy(*keys).agg(*aggregates), by_route, keys, ["_routes"])
    else:
        table = df.groupBy(*keys).agg(*aggregates)
    wanted = {f"_{m}": (QUANTILES[m].q, QUANTILES[m].method) for m in measures if m in QUANTILES}
    return _with(table, group_quantiles(df, keys, DELAY, wanted), keys, list(wanted))


def _with(table: DataFrame, more: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Both have one row for each group; null keys are equal."""
    same = reduce(and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], F.lit(True))
    return table.alias("a").join(more.alias("b"), same).select("a.*", *[f"b.{c}" for c in columns])


def _ranked(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    partials: dict[str, Column],
    threshold: float,
) -> DataFrame:
    """Partials per group with a column ``_<name>`` per quantile (and ``_routes``).

    What depends on the delay alone is worked out per delay value afterwards, from its count.
    Distinct routes ride along as a second grouping set, so the input is read once.
    """
    if "distance" in measures:
        raise ValueError("the first distance cannot be combined with exact quantiles")
    from_value = {f"_sum_{DELAY}", f"_n_{DELAY}", "_late"} & set(partials)
    aggregates = [c.alias(n) for n, c in partials.items() if n not in from_value]
    if "unique_routes" in measures:
        counts = df.groupingSets(
            [[*keys, DELAY], [*keys, "ROUTE"]], *keys, DELAY, "ROUTE"
        ).agg(*aggregates, (F.grouping(DELAY) == 0).alias("_by_value"))
    else:
        counts = df.groupBy(*keys, DELAY).agg(*aggregates, F.lit(True).alias("_by_value"))

    known = F.when(F.col("_by_value") & F.col(DELAY).isNotNull(), F.col("_rows")).otherwise(0)
    ordered = Window.partitionBy(*keys).orderBy(DELAY)
    to_here = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = counts.withColumns(
        {"_known": known, "_upto": F.sum(known).over(to_here), "_n": F.sum(known).over(whole)}
    )

    def at(rank: Column) -> Column:
        here = (F.col("_upto") - F.col("_known") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(here & (F.col("_known") > 0), F.col(DELAY)))

    combined = {
        n: F.sum(F.when(F.col("_by_value"), F.col(n))) for n in partials if n not in from_value
    }
    per_value = {
        f"_sum_{DELAY}": F.sum(F.col(DELAY) * F.col("_known")),
        f"_n_{DELAY}": F.sum("_known"),
        "_late": F.sum(F.when(fn.is_late(threshold, DELAY), F.col("_known")).otherwise(0)),
    }
    combined |= {n: per_value[n] for n in sorted(from_value)}
    for name in measures:
        if name in QUANTILES:
            values = [at(rank) for rank in QUANTILES[name].ranks(F.col("_n"))]
            combined[f"_{name}"] = values[0] if len(values) == 1 else (values[0] + values[1]) / 2
    if "unique_routes" in measures:
        combined["_routes"] = F.count_if(~F.col("_by_value"))
    return ranked.groupBy(*keys).agg(*[c.alias(n) for n, c in combined.items()])


def _finish(measure: str) -> Column:
    if measure in MEANS:
        column = MEANS[measure]
        return fn.ratio(F.col(f"_sum_{column}"), F.col(f"_n_{column}"))
    if measure in QUANTILES:
        return F.col(f"_{measure}")
    return {
        "total_flights": F.col("_rows"),
        "delayed_flights": F.col("_late"),
        "delay_rate": fn.ratio(F.col("_late"), F.col(f"_n_{DELAY}")),
        "distance": F.col("_distance"),
        "unique_routes": F.col("_routes"),
    }[measure]


def airport_kpis(silver: DataFrame, fractional: bool = False) -> DataFrame:
    table = kpi(silver, ["Origin", "Year", "Month"], AIRPORT, fractional=fractional)
    return table.orderBy("Year", "Month", "Origin")


def airline_kpis(silver: DataFrame, fractional: bool = False) -> DataFrame:
    table = kpi(silver, ["AIRLINE", "Year", "Month"], AIRLINE, fractional=fractional)
    return table.orderBy("Year", "Month", "AIRLINE")


def temporal_kpis(silver: DataFrame) -> DataFrame:
    keys = ["Year", "Month", "DAY_OF_WEEK", "DEP_HOUR", "SEASON"]
    return kpi(silver, keys, TEMPORAL).orderBy(*keys[:4])


def route_kpis(silver: DataFrame, min_flights: int = 10) -> DataFrame:
    table = kpi(silver, ["ROUTE", "Year", "Month"], ROUTE, min_flights)
    return table.orderBy("Year", "Month", "total_flights")


def _busiest_first(table: DataFrame) -> DataFrame:
    return table.orderBy(F.asc("Month"), F.desc_nulls_first("total_flights"))


def airport_kpis_simple(raw: DataFrame, min_flights: int = 100) -> DataFrame:
    return _busiest_first(kpi(raw, ["Origin", "Month"], AIRPORT_SIMPLE, min_flights))


def airline_kpis_simple(raw: DataFrame, min_flights: int = 1000) -> DataFrame:
    return _busiest_first(kpi(raw, [CARRIER, "Month"], AIRLINE_SIMPLE, min_flights))


def temporal_kpis_simple(raw: DataFrame, min_flights: int = 50) -> DataFrame:
    keys = ["Month", "DayOfWeek", "DEP_HOUR"]
    hours = raw.withColumn("DEP_HOUR", fn.hour_of("CRSDepTime"))
    return kpi(hours, keys, TEMPORAL_SIMPLE, min_flights).orderBy(*keys)
