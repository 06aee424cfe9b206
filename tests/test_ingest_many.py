"""Headers and types of many files, years that did not change, sums without an order."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from windrow.functions.exact import exact_mean, exact_sum
from windrow.operators import reports
from windrow.sources import headers, ingest, snapshots


def write(folder, name: str, text: str) -> str:
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def jobs_of(spark, group: str, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_headers_of_many_files_take_one_query(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    lines = ["a,b,c", "c,a", '"b",d']
    for i in range(600):
        write(folder, f"f {i:04d}.csv", f"{'' if i % 2 else chr(10)}{lines[i % 3]}\n{i},2\n")
    write(folder, "empty.csv", "")
    groups, _ = jobs_of(spark, "headers", lambda: headers.files_by_header(spark, [str(folder)]))
    assert {k: len(v) for k, v in groups.items()} == {("a", "b", "c"): 200, ("c", "a"): 200, ("b", "d"): 200}
    # Jobs of one query (adaptive execution runs each of its stages as one), not one for each file.
    _, jobs = jobs_of(spark, "many", lambda: headers.files_by_header(spark, [str(folder)]))
    assert jobs < 8


def test_types_are_the_narrowest_over_all_files(spark, tmp_path):
    one = write(tmp_path, "one.csv", "i,l,d,b,t,s,n\n1,1,1,true,2024-01-02 03:04:05,x,\n-2,2,2.5,false,2024-01-03,1,\n")
    two = write(tmp_path, "two.csv", 'd,i,l,s\n3,4,5000000000,"a,b"\n,,,\n')
    df = ingest.read_untyped_csv(spark, [one, two])
    assert dict(df.dtypes) == {"i": "int", "l": "bigint", "d": "double", "b": "boolean", "t": "timestamp", "s": "string", "n": "string"}
    rows = {(r["i"], r["l"], r["d"], r["b"], r["s"]) for r in df.collect()}
    assert rows == {(1, 1, 1.0, True, "x"), (-2, 2, 2.5, False, "1"), (4, 5000000000, 3.0, None, "a,b"), (None, None, None, None, None)}
    empty = write(tmp_path, "empty.csv", "")
    assert ingest.read_untyped_csv(spark, [empty]).columns == []


def test_files_of_one_folder_may_differ(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder, "a.csv", "Year,Month\n2020,1\n")
    write(folder, "b.csv", "Month,Year\n2,2021\n")
    rows = ingest.read_mixed_csv(spark, [str(folder)]).collect()
    assert sorted((r["Year"], r["Month"]) for r in rows) == [(2020, 1), (2021, 2)]


def test_a_rerun_writes_nothing(spark, table, flights):
    rows = flights(*[{"Year": 2020 + i % 3, "Month": 1 + i % 2} for i in range(30)], {"Year": None})
    source = ingest.with_ingest_metadata(rows)
    ingest.ingest_years(source, table)
    first = snapshots.current_version(spark, table)
    again = ingest.with_ingest_metadata(rows.repartition(7))
    report = {r["Year"]: (r["status"], r["row_count"]) for r in ingest.ingest_years(again, table, skip_unchanged=True).collect()}
    assert report == {y: ("unchanged", 0) for y in (2020, 2021, 2022, None)}
    assert snapshots.current_version(spark, table) == first
    twice = again.unionByName(again.where("Year = 2021"))
    report = {r["Year"]: r["status"] for r in ingest.ingest_years(twice, table, [2020, 2021, 2030], skip_unchanged=True).collect()}
    assert report == {2020: "unchanged", 2021: "written", 2030: "empty"}
    assert snapshots.read(spark, table).where("Year = 2021").count() == 20
    wider = again.withColumn("extra", F.lit(1))
    report = {r["Year"]: r["status"] for r in ingest.ingest_years(wider, table, [2020], skip_unchanged=True).collect()}
    assert report == {2020: "written"}


def test_digests_see_repeats_and_not_the_order(spark):
    rows = [(2020, "a", 1), (2020, "a", 1), (2020, "b", None), (2021, "a", 1)]
    df = spark.createDataFrame(rows, "Year int, v string, n int")

    def digests(frame):
        return {r["Year"]: tuple(r)[1:] for r in ingest.year_digests(frame, ["Year", "n", "v"]).collect()}

    assert digests(df.repartition(4)) == digests(df.coalesce(1))
    assert digests(df)[2020] != digests(df.distinct())[2020]
    assert ingest.unchanged_years(df, df.withColumn("n", F.col("n").cast("long"))) == set()
    assert ingest.unchanged_years(df, df.where("v = 'a'").union(df.where("v = 'b'"))) == {2020, 2021}


def values(seed: int) -> list[float]:
    made = random.Random(seed)
    some = [made.uniform(-1, 1) * 10 ** made.randint(-12, 15) for _ in range(2000)]
    return some + [0.1, -0.1, 1e16, -1e16, 2.0**93, -(2.0**93), 1e-300, -0.0]


def test_sums_do_not_depend_on_the_partitions(spark):
    data = values(1)
    df = spark.createDataFrame([(v,) for v in data], "v double")
    sums = [df.repartition(n).agg(exact_sum("v"), exact_mean("v")).first() for n in (1, 3, 200)]
    assert sums[0] == sums[1] == sums[2]
    small = [v for v in data if abs(v) < 1e14 and v != 1e-300]
    exact = spark.createDataFrame([(v,) for v in small], "v double").agg(exact_sum("v")).first()[0]
    assert exact == pytest.approx(float(sum(map(Fraction, small))), rel=1e-15)


@pytest.mark.parametrize(
    ("data", "total"),
    [([], None), ([None], None), ([None, 2.5, -1.0], 1.5), ([0.1] * 10, 1.0), ([1e300, 1.0], 1e300), ([math.inf, 1.0], math.inf),
     ([-3.75, -(2.0**40)], -3.75 - 2.0**40)],
)
def test_sums_of_odd_values(spark, data, total):
    found = spark.createDataFrame([(v,) for v in data], "v double").agg(exact_sum("v"), exact_mean("v")).first()
    known = [v for v in data if v is not None]
    assert found[0] == (pytest.approx(total, rel=1e-15) if total is not None else None)
    assert found[1] == (pytest.approx(total / len(known), rel=1e-15) if known else None)
    nan = spark.createDataFrame([(math.nan,), (1.0,)], "v double").agg(exact_sum("v")).first()[0]
    assert math.isnan(nan)


def test_means_by_group(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", None), (None, 3.0)], "k string, v double")
    got = {r["k"]: r["v"] for r in reports.exact_means(df, ["k"], ["v"]).collect()}
    assert got == {"a": pytest.approx(0.15), "b": None, None: 3.0}
