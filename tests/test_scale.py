"""Steps that must not deal out or sort all rows, and results that stay what they were."""

from pyspark.sql import functions as F

from windrow.operators import importance, maintenance, selection, zorder
from windrow.session import scratch_path
from windrow.sources import fixture, headers, snapshots


def _table(spark, rows=40):
    table = scratch_path(spark, "scale")
    df = spark.range(rows).select(
        (F.lit(2018) + F.col("id") % 4).cast("int").alias("Year"), F.concat(F.lit("k"), "id").alias("flight_id"),
        F.col("id").cast("double").alias("DepDelay"),
    )
    for year in range(2018, 2022):
        snapshots.commit(df.where(F.col("Year") == year), table, ["Year"], "append")
    return table, df


def test_compaction_of_everything_moves_no_rows(spark, monkeypatch):
    table, df = _table(spark)
    monkeypatch.setattr(maintenance, "_rewrite", lambda *a, **k: 1 / 0)
    version = maintenance.compact(spark, table, everything=True)
    assert snapshots.commits(spark, table)[-1].operation == "compact"
    after = snapshots.read(spark, table, version)
    assert after.drop(*snapshots.VERSION_COLUMNS).exceptAll(df.select("flight_id", "DepDelay", "Year")).isEmpty()
    assert after.count() == 40


def test_upsert_names_the_partitions_it_reads(spark, monkeypatch):
    table, df = _table(spark)
    new = df.where("Year in (2018, 2021)")
    existing = snapshots.read(spark, table).drop(*snapshots.VERSION_COLUMNS)
    touched = snapshots._touched(existing, new, ["Year"])
    plan = maintenance.explain(touched)
    assert "Exchange" not in plan and "Join" not in plan
    assert {r["Year"] for r in touched.collect()} == {2018, 2021}
    monkeypatch.setattr(snapshots, "MAX_TOUCHED", 1)
    assert {r["Year"] for r in snapshots._touched(existing, new, ["Year"]).collect()} == {2018, 2021}
    assert snapshots._touched(existing, new.where("Year = 1"), ["Year"]).isEmpty()


def test_versions_are_compared_by_the_partitions_that_differ(spark):
    table, df = _table(spark)
    before = snapshots.current_version(spark, table)
    # k0 leaves, k1 (which another partition has) comes, and a new key.
    kept = df.where("Year = 2018 and flight_id <> 'k0'")
    other = df.where("flight_id in ('k1', 'k2')").withColumns(
        {"Year": F.lit(2018), "flight_id": F.when(F.col("flight_id") == "k2", "new").otherwise(F.col("flight_id"))}
    )
    snapshots.commit(kept.unionByName(other), table, ["Year"], "replace")
    found = maintenance.compare_versions(spark, table, keys=["flight_id"]).collect()
    assert [tuple(r) for r in found] == [(before, 40, 0, 0), (before + 1, 41, 1, 1)]
    folders = [set(snapshots.leaf_folders(spark, table, v)) for v in (before, before + 1)]
    assert len(folders[0] & folders[1]) == 3


def test_bronze_is_written_where_its_rows_are(spark, monkeypatch):
    layouts = []
    monkeypatch.setattr(snapshots, "commit", lambda *a, layout=True, **k: layouts.append(layout))
    monkeypatch.setattr(snapshots, "read", lambda *a, **k: spark.createDataFrame([], "a int"))
    monkeypatch.setattr(fixture, "_bronze_tables", {})
    fixture.bronze(spark, "/root/testdata/sf0.001")
    assert layouts == [False]


def test_a_stratified_split_does_not_deal_rows_out_by_class(spark):
    df = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("flight_id"), (F.col("id") % 2).alias("late"))
    split = selection.split_stratified(df, "late")
    plan = maintenance.explain(split)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert {tuple(r) for r in split.where("is_test").groupBy("late").count().collect()} == {(0, 200), (1, 200)}


def test_ranks_are_the_same_however_they_are_looked_up(spark, monkeypatch):
    df = spark.range(3000).select(
        F.when(F.col("id") % 50 > 0, F.md5(F.col("id").cast("string"))).alias("text"),
        F.when(F.col("id") % 70 > 0, F.col("id") % 900 - 400.5).alias("number"), (F.col("id") % 3).alias("few"),
    )
    columns = ["text", "number", "few"]

    def ranks(budget):
        ranked, bits = zorder.with_ranks(df, columns, budget)
        return bits, sorted(map(str, ranked.collect()))

    for budget in (12, 63):
        joined = ranks(budget)
        monkeypatch.setattr(zorder, "FEW_VALUES", 10)
        assert ranks(budget) == joined
        plan = maintenance.explain(zorder.with_ranks(df, columns, 12)[0])
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin Left") <= 2
        monkeypatch.setattr(zorder, "MAX_BOUNDS", 0)
        assert ranks(budget) == joined
        monkeypatch.undo()


def test_ranges_of_a_clustered_folder_grow_with_the_rows(spark, monkeypatch):
    df = spark.range(100).select(F.col("id").alias("a"))
    monkeypatch.setattr(zorder, "RANGE_ROWS", 10)
    path = scratch_path(spark, "ranges")
    zorder.write_clustered(df, path, ["a"], files=2)
    assert len(spark.read.parquet(path).inputFiles()) >= 8
    assert spark.read.parquet(path).count() == 100


def test_shuffling_deals_rows_out_once(spark):
    path = scratch_path(spark, "shuffling")
    spark.range(300).select(F.concat(F.lit("k"), "id").alias("flight_id"), "id", F.lit("x").alias("wide")).write.parquet(path)
    df = spark.read.parquet(path)
    moved = importance.shuffled(df, "id", stored=True).select("flight_id", "id")
    plan = maintenance.explain(moved)
    assert plan.count("hashpartitioning") == 1 and "wide" not in plan
    assert sorted(r["id"] for r in moved.collect()) == list(range(300))


def test_shuffling_of_repeated_and_null_keys(spark):
    """What rows that share a key did before: they go, and the next row stands there for each."""
    rows = [("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)]
    df = spark.createDataFrame(rows, "flight_id string, v int")
    moved = sorted(((r["flight_id"] or ""), r["v"]) for r in importance.shuffled(df, "v").collect())
    kept = [k for k, _ in moved]
    assert kept.count("a") == 0 and len(moved) == 4 and set(kept) == {"b", "c", ""}
    assert {1, 2} < {v for _, v in moved}


def test_types_that_a_few_rows_rule_out_are_not_tried_on_all(spark, monkeypatch):
    df = spark.createDataFrame(
        [("1", "x", None, "2", "9"), ("2", "y", None, "3", "7")] * 60 + [("3000000000", "1", None, "2.5", "no")],
        "a string, b string, c string, d string, e string",
    ).coalesce(1)
    tried, found = [], headers._kinds_that_hold
    monkeypatch.setattr(headers, "_kinds_that_hold", lambda d, k: tried.append(k) or found(d, k))
    assert headers.narrowest_types(df) == {"a": "bigint", "b": "string", "c": "string", "d": "double", "e": "string"}
    assert tried[1]["b"] == [] and tried[1]["a"][:3] == ["int", "bigint", "double"]
    assert headers.narrowest_types(df.limit(0)) == dict.fromkeys("abcde", "string")
