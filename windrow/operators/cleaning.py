"""Silver operators: row-quality rules, code normalisation and derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions import columns as fn
from windrow.schemas import (
    CARRIER, CRITICAL_COLUMNS, DELAY_BOUNDS, DISTANCE_BOUNDS, SILVER_COLUMNS, SPEED_BOUNDS,
)


def filter_year(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("Year") == year)


def quality_rules(df: DataFrame) -> dict[str, Column]:
    """Named keep-rules in order; a rule whose columns are absent is left out."""
    have = set(df.columns)
    rules = {"not_cancelled": F.col("Cancelled") == 0}
    present = [c for c in CRITICAL_COLUMNS if c in have]
    if present:
        rules["critical_present"] = _all(F.col(c).isNotNull() for c in present)
    for name, column, bounds in [
        ("arrival_delay", "ArrDelay", DELAY_BOUNDS),
        ("departure_delay", "DepDelay", DELAY_BOUNDS),
        ("distance", "Distance", DISTANCE_BOUNDS),
    ]:
        if column in have:
            rules[name] = F.col(column).between(*bounds)
    if {"Distance", "AirTime"} <= have:
        rules["speed"] = fn.speed_mph().between(*SPEED_BOUNDS)
    return rules


def _all(conditions) -> Column:
    combined = None
    for condition in conditions:
        combined = condition if combined is None else combined & condition
    return combined


def clean(df: DataFrame) -> DataFrame:
    """Rows that satisfy every quality rule. The range rules reach the file scan."""
    return df.where(_all(quality_rules(df).values()))


def clean_steps(df: DataFrame) -> DataFrame:
    """Rows left after each rule, applied one after another, in one pass."""
    counts, kept = [F.count(F.lit(1)).alias("all")], F.lit(True)
    for name, rule in quality_rules(df).items():
        kept = kept & rule
        counts.append(F.count_if(kept).alias(name))
    totals = df.agg(*counts)
    steps = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(c).alias("rule"), F.col(c).alias("rows_left"))
            for i, c in enumerate(totals.columns)
        ]
    )
    return totals.select(F.inline(steps))


def clean_report(df: DataFrame) -> DataFrame:
    """Rows dropped per rule, each row charged to the first rule it fails; the rest is kept."""
    first_failed = None
    for name, rule in quality_rules(df).items():
        failed = ~F.coalesce(rule, F.lit(False))
        first_failed = (
            F.when(failed, name) if first_failed is None else first_failed.when(failed, name)
        )
    return df.groupBy(first_failed.otherwise("kept").alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def fill_nulls_by_type(df: DataFrame) -> DataFrame:
    """Zero, empty text or false for nulls by declared type; other types, and NaN, stay."""
    fill: dict[str, Column] = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.FractionalType | T.IntegralType):
            value: float | str | bool = 0
        elif isinstance(field.dataType, T.StringType):
            value = ""
        elif isinstance(field.dataType, T.BooleanType):
            value = False
        else:
            continue
        fill[field.name] = F.coalesce(F.col(field.name), F.lit(value).cast(field.dataType))
    return df.withColumns(fill) if fill else df


def normalize_categories(df: DataFrame) -> DataFrame:
    """Upper-case, stripped carrier (as ``AIRLINE``) and airport codes."""
    codes = {}
    if CARRIER in df.columns:
        codes["AIRLINE"] = fn.code(CARRIER)
    elif "AIRLINE" in df.columns:
        codes["AIRLINE"] = fn.code("AIRLINE")
    for airport in ("Origin", "Dest"):
        if airport in df.columns:
            codes[airport] = fn.code(airport)
    return df.withColumns(codes)


def date_parts(df: DataFrame, date: str = "FL_DATE", lenient: bool = False) -> DataFrame:
    """Weekday (Monday = 1) and month of a ``yyyy-MM-dd`` text column.

    Text that is no date raises, or gives nulls in the lenient form.
    """
    if lenient:
        day = F.try_to_timestamp(F.col(date), F.lit("yyyy-MM-dd"))
    else:
        day = F.to_timestamp(F.col(date), "yyyy-MM-dd")
    return df.withColumns({"DAY_OF_WEEK": fn.iso_weekday(day), "MONTH_NUM": F.month(day)})


def derive_features(df: DataFrame, from_date: bool = False) -> DataFrame:
    """Hour, weekday, season, route and delay class, for the columns that are there.

    With ``from_date`` weekday and season come from the ``FL_DATE`` text.
    """
    have = set(df.columns)
    if from_date and "FL_DATE" in have:
        df, month = date_parts(df), "MONTH_NUM"
        have.add(month)
    else:
        month = "Month"
    derived = {}
    if "CRSDepTime" in have:
        derived["DEP_HOUR"] = fn.hour_of("CRSDepTime")
    if not from_date and "DayOfWeek" in have:
        derived["DAY_OF_WEEK"] = F.col("DayOfWeek")
    if month in have:
        derived["SEASON"] = fn.season(month)
    if {"Origin", "Dest"} <= have:
        derived["ROUTE"] = fn.route()
    if "ArrDelay" in have:
        derived["DELAY_CATEGORY"] = fn.delay_category()
    return df.withColumns(derived)


def select_available(df: DataFrame, wanted: list[str] = SILVER_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])
