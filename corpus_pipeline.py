"""The training-data pipeline: from documents to token files in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.

1. quality: documents that the line model scores below its threshold go;
2. near duplicates: of each group of linked documents the one of smallest id stays;
3. decontamination: documents that hold a benchmark item go;
4. mixing: documents are drawn by calibrated probabilities;
5. token files: what is left is encoded, written, and read back as one digest for each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import decontamination, jaccard_join, mixing, quality_crf, registry, token_files
from windrow.llm.common import let_workers_import, new_path, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose score reaches the threshold; the model is fitted on labelled rows
    of the stage's input."""
    let_workers_import(spark)
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    scored = quality_crf.score_documents(docs, model, keep=True, score_column=name)
    return scored.where(F.col(name) >= quality_crf.THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component: that of smallest id. Rows that repeat its id go as
    well; rows without an id stay."""
    let_workers_import(spark)
    joined = stored(jaccard_join.join_documents(docs), "near-duplicates")
    gone = joined.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    repeated = joined.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null")
    if repeated.isEmpty():
        return kept
    first = F.xxhash64(*docs.columns)
    again = kept.join(repeated.select("doc_id"), "doc_id", "left_semi")
    chosen = again.groupBy("doc_id").agg(
        F.min_by(F.struct(*docs.columns), first).alias("row")
    ).select("row.*")
    return kept.join(repeated.select("doc_id"), "doc_id", "left_anti").select(docs.columns).unionByName(chosen)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; rows without an id as well, and of rows that
    share one only those whose text holds an item."""
    let_workers_import(spark)
    key = "row_key"
    while key in docs.columns:
        key = f"_{key}"
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    leaks = decontamination.find_leaks(keyed, table(spark, sf_dir, "benchmark"), id_column=key)
    leaks = stored(leaks.select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return keyed.join(leaks, key, "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the mix draws."""
    return mixing.keep_drawn(docs, registry.MIX_EXPONENTS, registry.MIX_RATE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token file of the remaining documents and returns its digests."""
    let_workers_import(spark)
    path = new_path(spark, "pipeline-tokens")
    token_files.write_token_file(docs, path, registry.tokenizer_path(), registry.END_ID)
    return token_files.token_digests(spark, path)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token files", encode),
]

#: The quality model cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
