"""Versioned tables: what each version holds, and what maintenance may and may not change."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from dates import day
from pyspark.sql import functions as F

from windrow.operators import maintenance
from windrow.sources import ingest, snapshots


def rows_of(df):
    names = [c for c in df.columns if c not in snapshots.VERSION_COLUMNS]
    return Counter(tuple(r) for r in df.select(*sorted(names)).collect())


def keys_of(df):
    return sorted(int(r["flight_id"], 16) for r in df.select("flight_id").collect())


@pytest.fixture
def two_years(flights):
    return flights({"Year": 2023}, {"Year": 2023}, {"Year": 2024}, {"Year": 2024, "Month": 2})


def test_versions_by_number_and_time(spark, table, flights, two_years):
    snapshots.commit(two_years, table, ["Year"], committed_at=day(0))
    snapshots.commit(flights({"flight_id": f"{9:032x}"}), table, ["Year"], committed_at=day(1))
    assert keys_of(snapshots.read(spark, table, version=0)) == [0, 1, 2, 3]
    assert keys_of(snapshots.read(spark, table)) == [0, 1, 2, 3, 9]
    noon = datetime(2024, 1, 1, 12)
    assert keys_of(snapshots.time_travel(spark, table, timestamp=noon)) == [0, 1, 2, 3]
    assert rows_of(snapshots.read(spark, table, version=0)) == rows_of(two_years)
    with pytest.raises(snapshots.VersionNotFound):
        snapshots.read(spark, table, version=2)
    with pytest.raises(snapshots.VersionNotFound):
        snapshots.read(spark, table, timestamp=datetime(2023, 1, 1))
    with pytest.raises(ValueError):
        snapshots.time_travel(spark, table)


def test_commit_time_reads_back(spark, table, two_years):
    snapshots.commit(two_years, table, ["Year"], committed_at=day(3))
    row = snapshots.read(spark, table).select("_version", "_operation", "_committed_at").first()
    assert tuple(row) == (0, "append", day(3))


def test_overwrite_hides_earlier_rows(spark, table, flights, two_years):
    snapshots.commit(two_years, table, ["Year", "Month"], "overwrite")
    snapshots.commit(flights({"Year": 2020}), table, ["Year", "Month"], "overwrite")
    assert snapshots.read(spark, table).count() == 1
    assert snapshots.read(spark, table, version=0).count() == 4


def test_replace_takes_the_place_of_its_partitions_only(spark, table, flights, two_years):
    by = ["Year", "Month"]
    snapshots.commit(two_years, table, by, "append")
    new = flights({"Year": 2024, "flight_id": f"{7:032x}"})
    snapshots.commit(new, table, by, "replace")
    assert keys_of(snapshots.read(spark, table)) == [0, 1, 3, 7]
    assert keys_of(snapshots.read(spark, table, version=0)) == [0, 1, 2, 3]
    snapshots.commit(new.withColumn("flight_id", F.lit(f"{8:032x}")), table, by, "replace")
    assert keys_of(snapshots.read(spark, table)) == [0, 1, 3, 8]
    assert keys_of(snapshots.read(spark, table, version=1)) == [0, 1, 3, 7]


def test_unfinished_write_is_not_a_version(spark, table, tmp_path, two_years):
    snapshots.commit(two_years, table, ["Year"])
    torn = tmp_path / "table" / "_version=1" / "_operation=append"
    torn = torn / "_committed_at=20240102T000000.000000Z" / "Year=2024"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_bytes(b"torn")
    assert snapshots.current_version(spark, table) == 0
    assert snapshots.read(spark, table).count() == 4
    assert snapshots.commit(two_years, table, ["Year"]) == 2
    assert snapshots.read(spark, table).count() == 8


def test_upsert_replaces_and_adds(spark, table, flights, two_years):
    keys = ["Year", "flight_id"]
    snapshots.merge_with_existing(two_years, table, keys, ["Year"])
    new = flights({"Year": 2023, "DepDelay": 99.0}, {"Year": 2025, "flight_id": f"{5:032x}"})
    for _ in range(2):
        snapshots.merge_with_existing(new, table, keys, ["Year"])
        got = {int(r["flight_id"], 16): r["DepDelay"] for r in snapshots.read(spark, table).collect()}
        assert got == {0: 99.0, 1: 5.0, 2: 5.0, 3: 5.0, 5: 5.0}
    assert snapshots.commits(spark, table)[-1].operation == "replace"


def test_upsert_moves_a_row_between_partitions_when_the_key_allows(spark, table, flights, two_years):
    snapshots.merge_with_existing(two_years, table, ["flight_id"], ["Year"])
    moved = flights({"Year": 2020})
    snapshots.merge_with_existing(moved, table, ["flight_id"], ["Year"])
    got = {int(r["flight_id"], 16): r["Year"] for r in snapshots.read(spark, table).collect()}
    assert got == {0: 2020, 1: 2023, 2: 2024, 3: 2024}
    assert snapshots.commits(spark, table)[-1].operation == "upsert"


def test_upsert_in_a_null_partition(spark, table, flights):
    keys = ["Month", "flight_id"]
    snapshots.merge_with_existing(flights({"Month": None}, {}), table, keys, ["Month"])
    snapshots.merge_with_existing(flights({"Month": None, "DepDelay": 1.0}), table, keys, ["Month"])
    got = {r["Month"]: r["DepDelay"] for r in snapshots.read(spark, table).collect()}
    assert got == {None: 1.0, 1: 5.0} and snapshots.read(spark, table).count() == 2


def test_merge_overwrites_by_default(spark, table, flights, two_years):
    snapshots.merge_with_existing(two_years, table, partition_by=["Year"])
    snapshots.merge_with_existing(flights({}), table, partition_by=["Year"])
    assert snapshots.read(spark, table).count() == 1


def test_empty_commit_adds_nothing(spark, table, two_years):
    snapshots.commit(two_years, table, ["Year"])
    snapshots.commit(two_years.where("Year = 1900"), table, ["Year"])
    assert snapshots.read(spark, table).count() == 4
    snapshots.commit(two_years.where("Year = 1900"), table, ["Year"], "overwrite")
    empty = snapshots.read(spark, table)
    assert empty.count() == 0 and set(two_years.columns) <= set(empty.columns)
    assert [r["row_count"] for r in maintenance.history(spark, table).collect()] == [0, 0, 4]
    snapshots.commit(two_years, table, ["Year"])
    assert rows_of(snapshots.read(spark, table)) == rows_of(two_years)


def test_compaction_and_clustering_keep_every_row(spark, table, flights):
    first = flights(*[{"Month": i % 12 + 1, "Origin": f"A{i % 5}"} for i in range(60)])
    for version in range(3):
        snapshots.commit(first, table, ["Year", "Month"], committed_at=day(version))
    before = rows_of(snapshots.read(spark, table))
    files = maintenance.table_info(spark, table)["file_count"]
    maintenance.compact(spark, table, committed_at=day(3))
    assert rows_of(snapshots.read(spark, table)) == before
    assert maintenance.table_info(spark, table)["file_count"] < files
    maintenance.cluster(spark, table, ["Month", "Origin", "flight_id"], 2000, day(4))
    after = snapshots.read(spark, table)
    assert rows_of(after) == before and "_z" not in after.columns
    assert snapshots.read(spark, table, version=1).count() == 120


def test_one_hot_partition_is_cut_into_files(spark, table, flights):
    snapshots.commit(flights(*[{"DepDelay": float(i)} for i in range(400)]), table, ["Year"])
    size = maintenance.table_info(spark, table)["size_bytes"]
    maintenance.compact(spark, table, target_bytes=size // 3, everything=True)
    assert maintenance.table_info(spark, table)["file_count"] >= 3


def test_small_partitions_become_one_file_each(spark, table, flights):
    rows = flights(*[{"Month": i % 12 + 1} for i in range(48)])
    for _ in range(3):
        snapshots.commit(rows, table, ["Year", "Month"])
    maintenance.compact(spark, table)
    assert maintenance.table_info(spark, table)["file_count"] == 12
    assert rows_of(snapshots.read(spark, table)) == rows_of(rows.union(rows).union(rows))


def test_unpartitioned_table_is_compacted(spark, table, flights):
    rows = flights({}, {}, {})
    for _ in range(2):
        snapshots.commit(rows, table)
    maintenance.compact(spark, table)
    assert maintenance.table_info(spark, table)["file_count"] == 1
    assert rows_of(snapshots.read(spark, table)) == rows_of(rows.union(rows))


def test_ranks_follow_the_values(spark, flights):
    df = flights(*[{"Distance": float(i % 10), "Origin": f"O{i:04d}"} for i in range(1000)])
    bounds = maintenance.rank_bounds(df, ["Distance", "Origin"])
    assert bounds["Distance"] == [float(i) for i in range(10)]
    assert 200 <= len(bounds["Origin"]) <= maintenance.MAX_RANKS
    ranked = df.select(
        "Origin", maintenance.rank_of("Origin", bounds["Origin"]).alias("r"),
        "Distance", maintenance.rank_of("Distance", bounds["Distance"]).alias("d"),
    ).orderBy("Origin").collect()
    assert [r["r"] for r in ranked] == sorted(r["r"] for r in ranked)
    assert all(r["d"] == r["Distance"] for r in ranked)
    with pytest.raises(ValueError):
        maintenance.z_value([F.lit(1)] * 8, [1] * 8)


def test_vacuum_removes_only_what_no_one_needs(spark, table, two_years):
    for version in range(2):
        snapshots.commit(two_years, table, ["Year"], committed_at=day(version))
    late = datetime(2024, 2, 1)
    assert maintenance.vacuum(spark, table, now=late) == 0
    maintenance.compact(spark, table, committed_at=day(2), everything=True)
    assert maintenance.vacuum(spark, table, now=day(5)) == 0
    preview = maintenance.vacuum_preview(spark, table, now=late).collect()
    assert [r["_version"] for r in preview] == [1, 0]
    assert snapshots.read(spark, table, version=0).count() == 4
    assert maintenance.vacuum(spark, table, now=late) == 4
    assert snapshots.read(spark, table).count() == 8
    for gone in (0, 1):
        with pytest.raises(snapshots.VersionNotFound):
            snapshots.read(spark, table, version=gone)
    assert maintenance.vacuum(spark, table, now=late) == 0


def test_half_done_vacuum_is_noticed(spark, table, tmp_path, two_years):
    for version in range(2):
        snapshots.commit(two_years, table, ["Year"], committed_at=day(version))
    (tmp_path / "table" / "_version=0").rename(tmp_path / "elsewhere")
    with pytest.raises(snapshots.VersionNotFound):
        snapshots.read(spark, table, version=1)


def test_history_stats_and_compare(spark, table, flights, two_years):
    snapshots.commit(two_years, table, ["Year"], committed_at=day(0))
    snapshots.commit(flights({"flight_id": "f" * 32}), table, ["Year"], "overwrite", day(1))
    rows = [tuple(r) for r in maintenance.history(spark, table).collect()]
    assert rows == [(1, "overwrite", day(1), 1), (0, "append", day(0), 4)]
    counts = {r["version"]: r["row_count"] for r in
              maintenance.compare_versions(spark, table).collect()}
    assert counts == {0: 4, 1: 1}
    keyed = maintenance.compare_versions(spark, table, keys=["flight_id"]).orderBy("version")
    assert [tuple(r) for r in keyed.collect()] == [(0, 4, 0, 0), (1, 1, 1, 4)]
    info = maintenance.table_info(spark, table)
    assert (info["version"], info["file_count"]) == (1, 1)
    assert info["partition_columns"] == ["Year"] and info["size_bytes"] > 0
    assert info["created_at"].replace(tzinfo=None) == day(0)
    stats = {r["table_name"]: r for r in
             maintenance.tables_stats(spark, {"a": table, "b": table + "-none"}).collect()}
    assert (stats["a"]["row_count"], stats["a"]["error"]) == (1, None)
    assert "no versions" in stats["b"]["error"]


def test_new_column_reads_as_null_before(spark, table, two_years):
    snapshots.commit(two_years, table, ["Year"])
    extra = two_years.where("Year = 2024").withColumn("Tail", F.lit("N1"))
    snapshots.commit(extra, table, ["Year"])
    merged = snapshots.read(spark, table)
    assert merged.where("Tail IS NULL").count() == 4 and merged.count() == 6
    names = [r["column_name"] for r in maintenance.schema_of(spark, table).collect()]
    assert "Tail" in names and "_version" not in names


def test_optimise_and_vacuum_go_on_after_an_error(spark, tmp_path, two_years):
    tables = {name: str(tmp_path / name) for name in ("good", "bad", "missing")}
    for name in ("good", "bad"):
        snapshots.commit(two_years, tables[name], ["Year"])
    done = maintenance.optimize_tables(spark, tables, {"bad": ["nothing"], "good": ["Month"]})
    got = {r["table_name"]: (r["version"], r["error"] is None) for r in done.collect()}
    assert got == {"good": (1, True), "bad": (None, False)}
    removed = maintenance.vacuum_tables(spark, tables, 0, datetime(2100, 1, 1)).collect()
    assert {r["table_name"]: r["removed_files"] for r in removed} == {
        "good": 2, "bad": 0, "missing": 0,
    }


def test_csv_round_trip_keeps_blanks_and_matches_by_name(spark, tmp_path, flights):
    path = str(tmp_path / "csv")
    df = flights({"Origin": " jfk ", "Dest": None}, {"Origin": 'a "b", c'})
    shuffled = df.select(*reversed(df.columns), F.lit("x").alias("Extra"))
    ingest.write_csv(shuffled, path)
    back = ingest.read_csv(spark, path)
    assert back.columns == shuffled.columns
    assert dict(back.dtypes)["Distance"] == "double" and dict(back.dtypes)["Extra"] == "string"
    assert rows_of(back) == rows_of(shuffled)
    inferred = ingest.read_csv(spark, path, schema=None)
    assert dict(inferred.dtypes)["Year"] == "int"


def test_ingest_reports_and_repeats_without_duplicates(spark, table, two_years):
    rows = ingest.with_ingest_metadata(two_years, datetime(2024, 5, 1))
    for _ in range(2):
        report = ingest.ingest_years(rows, table, [2023, 2024, 2025])
        assert {tuple(r) for r in report.collect()} == {
            (2023, 2, "written"), (2024, 2, "written"), (2025, 0, "empty"),
        }
        assert snapshots.read(spark, table).count() == 4
    assert set(snapshots.read(spark, table).select("source_layer").first()) == {"bronze"}
    assert snapshots.read(spark, table, version=0).count() == 4


def test_ingest_of_no_known_year(spark, table, two_years):
    report = ingest.ingest_years(two_years, table, [1999])
    assert [tuple(r) for r in report.collect()] == [(1999, 0, "empty")]


def test_ingest_fills_nulls_only_when_asked(spark, tmp_path, flights):
    df = flights({"AirTime": None})
    for fill, expected in ((False, None), (True, 0.0)):
        path = str(tmp_path / str(fill))
        ingest.ingest_years(df, path, [2024], fill_nulls=fill)
        assert snapshots.read(spark, path).first()["AirTime"] == expected


def test_a_failing_year_does_not_stop_the_others(spark, table, two_years):
    bad = F.when(F.col("Year") == 2023, F.raise_error(F.lit("bad"))).otherwise(F.col("Dest"))
    report = ingest.ingest_years(two_years.withColumn("Dest", bad), table, [2023, 2024, 2025])
    assert {tuple(r) for r in report.collect()} == {
        (2023, 0, "failed"), (2024, 2, "written"), (2025, 0, "empty"),
    }
    assert snapshots.read(spark, table).count() == 2


def test_csv_stands_in_for_a_missing_table(spark, tmp_path, two_years):
    csv, table = str(tmp_path / "csv"), str(tmp_path / "table")
    ingest.write_csv(two_years, csv)
    assert ingest.table_or_csv(spark, table, csv).count() == 2
    snapshots.commit(two_years, table, ["Year"])
    assert ingest.table_or_csv(spark, table, csv).count() == 4


@pytest.mark.parametrize("rewrite", ["compact", "cluster", "upsert"])
def test_rewrites_keep_later_columns(spark, table, two_years, rewrite):
    snapshots.commit(two_years, table, ["Year"])
    extra = two_years.where("Year = 2024").withColumn("Tail", F.lit("N1"))
    snapshots.commit(extra, table, ["Year"])
    before = rows_of(snapshots.read(spark, table))
    if rewrite == "compact":
        maintenance.compact(spark, table)
    elif rewrite == "cluster":
        maintenance.cluster(spark, table, ["Origin"])
    else:
        snapshots.upsert(two_years.limit(0), table, ["flight_id"], ["Year"])
    after = snapshots.read(spark, table)
    assert "Tail" in after.columns and rows_of(after) == before


def test_partition_values_keep_their_type(spark, table):
    rows = spark.createDataFrame([("007", 1), ("010", 2), (None, 3)], "p string, v int")
    snapshots.commit(rows, table, ["p"])
    maintenance.compact(spark, table, everything=True)
    assert {r["p"] for r in snapshots.read(spark, table).collect()} == {"007", "010", None}


def test_upsert_of_many_partitions_and_repeated_keys(spark, table):
    old = spark.range(3000).select(F.col("id").alias("p"), F.lit("old").alias("v"))
    snapshots.commit(old.repartition(1), table, ["p"], layout=False)
    new = old.where("p % 3 > 0").withColumn("v", F.lit("new"))
    snapshots.upsert(new, table, ["p"], ["p"])
    counts = {r["v"]: r["count"] for r in snapshots.read(spark, table).groupBy("v").count().collect()}
    assert counts == {"old": 1000, "new": 2000}
    with pytest.raises(ValueError):
        snapshots.upsert(new.unionByName(new), table, ["p"], ["p"])


def test_upsert_into_a_null_partition(spark, table):
    rows = spark.createDataFrame([(None, 1, "old"), (5, 2, "old")], "p int, k int, v string")
    snapshots.commit(rows, table, ["p"])
    snapshots.upsert(rows.where("p IS NULL").withColumn("v", F.lit("new")), table, ["p", "k"], ["p"])
    assert sorted(r["v"] for r in snapshots.read(spark, table).collect()) == ["new", "old"]


def test_a_second_compaction_writes_nothing(spark, table, two_years):
    for _ in range(3):
        snapshots.commit(two_years, table, ["Year"])
    first = maintenance.compact(spark, table)
    assert first == 3 and maintenance.compact(spark, table) == first
    assert snapshots.current_version(spark, table) == first
    assert snapshots.read(spark, table).count() == 3 * two_years.count()


def test_csv_by_name_and_loudly(spark, tmp_path, flights):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    ingest.write_csv(flights({"Year": 2023, "Month": 2}).select("Year", "Month"), one)
    ingest.write_csv(flights({"Year": 2024, "Month": 3}).select("Month", "Year"), two)
    rows = ingest.read_mixed_csv(spark, [one, two]).collect()
    assert sorted((r["Year"], r["Month"]) for r in rows) == [(2023, 2), (2024, 3)]
    with pytest.raises(Exception):
        ingest.read_csv(spark, [one, two]).collect()
    bad = str(tmp_path / "bad")
    ingest.write_csv(spark.createDataFrame([("2024.0", "1")], "Year string, Month string"), bad)
    with pytest.raises(Exception):
        ingest.read_csv(spark, bad).collect()
    counts = {r["column_name"]: r["bad_count"] for r in ingest.bad_values(spark, [one, bad]).collect()}
    assert counts["Month"] == 0


def test_a_year_that_left_the_source_is_reported_as_kept(spark, table, two_years):
    ingest.ingest_years(two_years, table)
    again = ingest.ingest_years(two_years.where("Year = 2024"), table).collect()
    status = {r["Year"]: r["status"] for r in again}
    assert set(status.values()) == {"kept", "written"} and status[2024] == "written"
    assert snapshots.read(spark, table).count() == two_years.count()
