"""Headers and types of many CSV files at once, however many there are."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Types a column may turn out to have, narrowest first; text holds everything else.
NARROWEST = ["int", "bigint", "double", "boolean", "timestamp"]
#: Rows that rule types out before all rows are looked at.
FIRST_ROWS = 100


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path and header: the first line with anything in it of every file below the paths.

    One job over all files, of which a file sends on one line for each of its first splits' tasks.
    Files without such a line have no row.
    """
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = lines.where((F.col("start") == 0) & (F.trim("value") != ""))
    # Lines of one split are numbered in their order.
    numbered = lines.select("path", F.struct(F.monotonically_increasing_id().alias("at"), "value").alias("line"))
    return numbered.groupBy("path").agg(F.min("line")["value"].alias("header"))


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. The driver gets the files' names, which it lists for every scan."""
    groups: dict[tuple[str, ...], list[str]] = {}
    grouped = headers(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    for row in grouped.orderBy("header").collect():
        columns = tuple(next(csv.reader([row["header"].lstrip("﻿")])))
        groups.setdefault(columns, []).extend(unquote(p) for p in row["paths"])
    return groups


def _holds(column: str, kind: str) -> Column:
    return F.col(f"`{column}`").isNull() | F.col(f"`{column}`").try_cast(kind).isNotNull()


def _kinds_that_hold(df: DataFrame, kinds: dict[str, list[str]]) -> tuple[dict[str, list[str]], list[int]]:
    """For each column those of its kinds that hold all of its values, and how many values it has."""
    names = list(kinds)
    checks = [F.every(_holds(c, k)).alias(f"{i}_{k}") for i, c in enumerate(names) for k in kinds[c]]
    known = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(names)]
    found = df.agg(*checks, *known).first()
    # Of no rows at all nothing is ruled out.
    hold = {c: [k for k in kinds[c] if found[f"{i}_{k}"] is not False] for i, c in enumerate(names)}
    return hold, [found[f"{i}_n"] for i in range(len(names))]


def narrowest_types(df: DataFrame) -> dict[str, str]:
    """For each text column the narrowest type that holds all of its values; text for a column of
    nulls.

    One value rules a type out, so a few rows first spare all others the types that cannot be; the
    types that remain are tried on every row, in one pass whose result is one row.
    """
    kinds, _ = _kinds_that_hold(df.limit(FIRST_ROWS), dict.fromkeys(df.columns, NARROWEST))
    kinds, known = _kinds_that_hold(df, kinds)
    return {c: kinds[c][0] if n and kinds[c] else "string" for c, n in zip(df.columns, known, strict=True)}


def read_inferred_csv(spark: SparkSession, paths: Sequence[str], options: dict[str, str | bool]) -> DataFrame:
    """CSV files whose headers differ, with the types of their values over all files: columns go
    by name, a column that a file lacks is null for its rows. No files give no columns.
    """
    frames = [
        spark.read.options(**options).schema(", ".join(f"`{c}` string" for c in columns)).csv(files)
        for columns, files in files_by_header(spark, paths).items()
    ]
    if not frames:
        return spark.createDataFrame([], "")
    texts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    types = narrowest_types(texts)
    return texts.select(*[F.col(f"`{c}`").cast(k).alias(c) for c, k in types.items()])
