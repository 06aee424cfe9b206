"""Packing without a shuffle, Z-values over many columns, and shuffled columns."""

from __future__ import annotations

import itertools
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from windrow.operators import importance, packing, zorder


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sizes_of(spark, path):
    return [(r["path"], r["length"]) for r in packing.data_files(spark, path).collect()]


def test_packing_keeps_rows_and_does_not_shuffle(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("01")).otherwise(F.lit("é x")).alias("p"), F.col("id"), F.sha1(F.col("id").cast("string")).alias("v")
    )
    rows.repartition(24).write.partitionBy("p").parquet(source)
    before = sizes_of(spark, source)
    whole = spark.read.parquet(source)
    packed = packing.packs(packing.data_files(spark, source), 200_000)
    reader = spark.read.option("basePath", source).schema(whole.schema)
    with packing.one_task_a_pack(spark):
        read = packing.read_packed(packed, lambda paths: reader.parquet(*paths))
        assert "Exchange" not in plan_of(read) and read.rdd.getNumPartitions() == len(packed)
    assert packing.compact_folder(spark, source, target, ["p"], 200_000, packs_at_once=3) == len(packed)
    after = sizes_of(spark, target)
    # The hot partition is cut into several packs, the other is not spread.
    assert len(before) == 48 and len(after) == len(packed) < 12
    assert len([p for p, _ in after if "p=01" in p]) > len([p for p, _ in after if "p=01" not in p]) >= 1
    again = spark.read.parquet(target).select(whole.columns)
    assert again.exceptAll(whole).count() == whole.exceptAll(again).count() == 0


def test_packing_merges_columns_that_came_later(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(source)
    spark.createDataFrame([(2, "b", 2.5)], "id int, v string, w double").write.mode("append").parquet(source)
    assert packing.compact_folder(spark, source, target) == 1
    assert sorted(map(tuple, spark.read.parquet(target).select("id", "v", "w").collect()), key=str) == [(1, "a", None), (2, "b", 2.5)]


def test_only_folders_with_small_files_are_needy(spark):
    files = spark.createDataFrame(
        [("f/p=1/a", 10), ("f/p=1/b", 90), ("f/p=2/a", 10), ("f/p=2/b", 20), ("f/p=3/a", 5)], "path string, length long"
    )
    assert sorted(r["path"] for r in packing.needy(files, 100).collect()) == ["f/p=2/a", "f/p=2/b"]
    assert packing.packs(files, 100) == [["f/p=1/a", "f/p=1/b"], ["f/p=2/a", "f/p=2/b"], ["f/p=3/a"]]
    assert packing.packs(files.limit(0), 100) == []


@pytest.mark.parametrize(
    ("distinct", "bits"),
    [([7, 12, 25], [3, 4, 5]), ([2**40, 2**40], [31, 31]), ([1, 0, 2], [0, 0, 1]), ([100_000] * 10, [6] * 10), ([2, 2**60], [1, 60])],
)
def test_bits_are_shared(distinct, bits):
    assert zorder.shared_bits(distinct) == bits and sum(bits) <= 63


def test_ranks_of_every_type(spark):
    made = random.Random(3)
    rows = [
        (i, made.choice([-1.5, 0.0, -0.0, 1e300, None]), made.choice("bca"), made.choice([True, False]),
         date(2020, 1, made.randint(1, 9)), datetime(2020, 1, 1, made.randint(0, 5)), made.choice([None, 5]))
        for i in range(50)
    ]
    df = spark.createDataFrame(rows, "i long, d double, s string, b boolean, t date, u timestamp, n int")
    columns = df.columns[1:]
    ranked, bits = zorder.with_ranks(df, columns)
    got = {r["i"]: r for r in ranked.collect()}
    for k, c in enumerate(columns, 1):
        order = sorted({r[k] + 0.0 if c == "d" else r[k] for r in rows if r[k] is not None})
        assert all(got[r[0]][f"_rank_{c}"] == (order.index(r[k]) if r[k] is not None else 0) for r in rows), c
        assert bits[c] == max(len(order) - 1, 0).bit_length()
    with pytest.raises(TypeError, match="without an order"):
        zorder.with_ranks(df.withColumn("m", F.array("i")), ["m"])


def test_z_of_ten_columns_with_many_values(spark):
    n = 20_000
    df = spark.range(n).select(*[((F.col("id") * k) % n).alias(f"c{k}") for k in (1, 3, 7, 9, 11, 13, 17, 19, 21, 23)])
    ranked, bits = zorder.with_ranks(df, df.columns)
    assert set(bits.values()) == {6}
    sizes = ranked.groupBy("_rank_c7").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
    assert sizes[2] == 64 and sizes[1] - sizes[0] <= 1
    assert zorder.with_z(df, df.columns).agg(F.min("_z") >= 0, F.count_distinct("_z") > 1000).first() == (True, True)


def test_interleaving_from_the_top(spark):
    df = spark.createDataFrame([(0b101, 0b1, 0b11)], "a long, b long, c long")
    # Tops 1 1 1, then 0 1, then 1.
    assert df.select(zorder.interleaved({"a": 3, "b": 1, "c": 2})).first()[0] == 0b111011


def test_clustered_files_have_narrow_ranges(spark, tmp_path):
    cells = [(x, y) for x, y in itertools.product(range(32), range(32))]
    random.Random(1).shuffle(cells)
    df = spark.createDataFrame(cells * 2, "x int, y int")
    zorder.write_clustered(df, str(tmp_path / "z"), ["x", "y"], files=16)
    written = spark.read.parquet(str(tmp_path / "z"))
    assert written.exceptAll(df).count() == df.exceptAll(written).count() == 0
    spans = written.groupBy(F.input_file_name()).agg(
        (F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y")
    ).collect()
    assert len(spans) > 8 and sorted((s["x"] + 1) * (s["y"] + 1) for s in spans)[len(spans) // 2] <= 128


def test_shuffling_moves_one_column_round(spark):
    rows = [(f"k{i:02d}", i, f"v{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "flight_id string, a int, b string").repartition(4)
    moved = importance.shuffled(df, "b").collect()
    assert sorted(r["b"] for r in moved) == sorted(r[2] for r in rows)
    assert {(r["flight_id"], r["a"]) for r in moved} == {r[:2] for r in rows}
    # One round through all rows.
    after = {f"v{r['a']}": r["b"] for r in moved}
    at, seen = "v0", set()
    while at not in seen:
        seen.add(at)
        at = after[at]
    assert len(seen) == 40
    again = {r["flight_id"]: r["b"] for r in importance.shuffled(df.repartition(1), "b").collect()}
    assert again == {r["flight_id"]: r["b"] for r in moved}
    assert importance.shuffled(df.limit(1), "b").collect() == df.limit(1).collect()


def test_features_that_matter_score_worse_when_shuffled(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("flight_id"), F.col("id").cast("double").alias("x"), F.col("id").alias("unused"),
        (F.col("id") * 2.0).alias("t"),
    )
    found = importance.permutation_importance(
        df, ["x", "unused"], lambda d: d.withColumn("prediction", F.col("x") * 2), F.avg(F.abs(F.col("t") - F.col("prediction")))
    )
    got = {r["feature"]: r for r in found.collect()}
    assert got["unused"]["importance"] == 0 and got["x"]["score"] == 0 and got["x"]["importance"] > 100
