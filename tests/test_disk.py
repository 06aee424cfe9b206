"""What writes leave on the disks."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

from windrow.plans.queries import _lake, _raw
from windrow.session import written_once
from windrow.sources import ingest, snapshots


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_what_a_write_dealt_out_is_gone_when_it_is_done(spark, table, flights):
    rows = flights(*[{"Year": 2018 + i % 7} for i in range(50)])
    before, held = _shuffle_files(spark), []
    for _ in range(3):
        held.append(rows.repartition(3))
        snapshots.commit(held[-1], table, ["Year"])
        held.append(written_once(rows.groupBy("Year").count(), "counts"))
    # Garbage collection may take away more, never add.
    assert _shuffle_files(spark) <= before
    assert snapshots.read(spark, table).count() == 150
    assert held[0].count() == 50 and held[1].count() == 7


def test_settings_are_what_they_were(spark, table, flights):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    snapshots.commit(flights({}), table)
    assert spark.conf.get(key) == before


def test_compressed_csv_has_the_same_rows_in_more_files(spark, tmp_path, monkeypatch, flights):
    monkeypatch.setattr(ingest, "ROWS_PER_FILE", 4)
    rows = flights(*[{"Origin": f" a,\"{i}\n"} for i in range(10)], {"Origin": None}).coalesce(1)
    path = str(tmp_path / "csv")
    ingest.write_csv(rows, path, "gzip")
    files = list(Path(path).glob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".csv.gz") for f in files)
    found = ingest.read_csv(spark, path, multiLine=True)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, rows.collect()))


def test_the_source_of_a_lake_is_compressed(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    files = list(Path(lake.source_csv).glob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
    assert ingest.read_csv(spark, lake.source_csv).count() == _raw(spark, sf_dir).count()
