"""The registered queries against their SQL on the smallest tables, and the pipeline."""

from __future__ import annotations

import duckdb
import pytest
from compare import difference
from made_up import prose
from pyspark.sql import functions as F

import corpus_pipeline
from windrow.llm.registry import llm_oracles, llm_queries

TABLES = "documents embeddings pages benchmark labels conversations".split()
NO_SQL = {"op1_token_files", "op4_decontamination", "op5_quality_crf", "op7_sharding", "op13_alignment"}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))
    assert set(llm_queries()) - set(llm_oracles()) == NO_SQL


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_its_oracle(spark, oracle, sf_dir, name):
    assert difference(spark, oracle, llm_queries()[name], llm_oracles()[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_query_without_oracle_returns_rows(spark, sf_dir, name):
    rows = llm_queries()[name](spark, sf_dir).count()
    assert 0 < rows <= 200 if name == "op4_decontamination" else rows == 200


def test_pipeline_stages(spark, make_docs, sf_dir, tmp_path):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    clean = [(k, f"{prose(k)}.\n{prose(k + 300)}.") for k in range(40)]
    rows = clean + [(100, clean[0][1]), (101, clean[1][1] + " end."), (102, f"{prose(7)} {item}")]
    docs = make_docs(rows)
    deduplicated = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in deduplicated.collect()) == [*range(40), 102]
    decontaminated = corpus_pipeline.decontaminate(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in decontaminated.collect()) == [*range(40), 100, 101]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_near_duplicates_keep_one_row_of_a_repeated_id(spark, make_docs, sf_dir):
    rows = [(1, prose(1)), (1, prose(1)), (1, prose(2)), (None, prose(1)), (None, None), (2, prose(1)), (3, None)]
    kept = corpus_pipeline.near_duplicates(spark, make_docs(rows, extra=True), sf_dir).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == [1, 3, None, None]


def test_decontamination_judges_each_row(spark, make_docs, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    leak = f"{prose(7)} {item}"
    rows = [(None, leak), (None, prose(8)), (None, None), (5, prose(9)), (5, leak), (6, ""), (7, leak), (8, prose(8))]
    docs = make_docs(rows).withColumn("row_key", F.lit("kept"))
    kept = corpus_pipeline.decontaminate(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([(None, prose(8)), (None, None), (5, prose(9)), (6, ""), (8, prose(8))], key=str)


def test_pipeline_runs(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert 50 < rows.count() < 200
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near duplicates", "decontamination", "mixing", "token files",
    ]
