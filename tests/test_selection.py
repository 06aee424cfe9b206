"""Samples and splits depend on keys only, whatever they look like, and are exact."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from windrow.operators import selection


def keyed(spark, n: int, label=lambda i: i % 3 == 0):
    rows = [(hashlib.md5(str(i).encode()).hexdigest(), int(label(i))) for i in range(n)]
    return spark.createDataFrame(rows, "flight_id string, y int")


def hashed(key) -> tuple[str, str]:
    return hashlib.md5(str(key).encode()).hexdigest(), key


def test_sample_has_the_lowest_hashes(spark):
    df = keyed(spark, 500)
    keys = sorted((r[0] for r in df.collect()), key=hashed)
    for n in (1, 50, 499, 500, 900):
        got = [r[0] for r in selection.sample_lowest(df, n).collect()]
        assert got == keys[:n]
    assert selection.sample_lowest(df.limit(0), 5).count() == 0


def test_sample_when_all_keys_share_a_prefix(spark):
    rows = [(f"{i:032x}",) for i in range(200)]
    df = spark.createDataFrame(rows, "flight_id string")
    got = [r[0] for r in selection.sample_lowest(df, 7).collect()]
    assert got == sorted((r[0] for r in rows), key=hashed)[:7]


def test_plain_number_keys_are_split_evenly(spark):
    df = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 12, "0").alias("flight_id"))
    assert 0.18 < selection.split_hash(df).where("is_test").count() / 20_000 < 0.22
    assert selection.sample_lowest(df, 100).count() == 100
    check_stratified(df.withColumn("y", F.lit(1)))


def test_hash_split_is_stable_and_about_the_asked_size(spark):
    df = keyed(spark, 4000)
    one = {tuple(r) for r in selection.split_hash(df).collect()}
    two = {tuple(r) for r in selection.split_hash(df.repartition(7)).collect()}
    assert one == two and len(one) == 4000
    assert 0.17 < sum(r[2] for r in one) / 4000 < 0.23
    low = selection.split_hash(selection.sample_lowest(df, 1000))
    assert 0.15 < low.where("is_test").count() / 1000 < 0.25


def check_stratified(df, test_size=0.2):
    rows = selection.split_stratified(df, "y", test_size).collect()
    by_class: dict = {}
    for row in rows:
        by_class.setdefault(row["y"], []).append((row["flight_id"], row["is_test"]))
    for members in by_class.values():
        flags = [test for _, test in sorted(members, key=lambda m: hashed(m[0]))]
        wanted = int(len(flags) * test_size + 0.5)
        assert flags == [True] * wanted + [False] * (len(flags) - wanted)
    return rows


def test_stratified_split_is_exact_per_class(spark):
    assert len(check_stratified(keyed(spark, 1000))) == 1000


def test_stratified_split_with_tiny_and_skewed_classes(spark):
    check_stratified(keyed(spark, 900, lambda i: 0 if i > 4 else i))


def test_stratified_split_of_many_classes(spark):
    check_stratified(keyed(spark, 300, lambda i: i % 9))


def test_flight_id_tells_nulls_and_values_apart(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "i int, s string")
    ids = selection.with_flight_id(df, ["i", "s"])
    assert ids.select("flight_id").distinct().count() == 3
    other = selection.with_flight_id(df, ["i", "s"], seed=7)
    assert ids.select("flight_id").intersect(other.select("flight_id")).count() == 0


def test_top_k_is_a_bounded_sort(spark):
    df = keyed(spark, 100)
    top = selection.top_k(df, [F.desc("flight_id")], 3)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in top.collect()] == sorted((r[0] for r in df.collect()), reverse=True)[:3]
