"""Exact top-k inner products by norm buckets with local pruning.

Candidates are sorted by length and cut into buckets. A query first meets its longest bucket,
whose k-th product is a floor no answer may fall below. In any other bucket only vectors with a
cosine of at least floor / (query length * longest vector) can matter; from that local
threshold each pair of query and bucket is skipped, pruned by length or by coordinates, and
what is left is verified with exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import stored

#: Vectors of one bucket, and queries of one block.
BUCKET_ROWS, QUERY_ROWS = 4096, 2048
#: Coordinates that a query's coordinate pruning looks at.
FOCUS = 4
#: Local cosine thresholds above this are pruned by coordinates, the rest by length.
COORDINATE_COSINE = 0.6
_HITS = "query_id bigint, score bigint, vec_id bigint"


def integer_vectors(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 64
) -> DataFrame:
    """id and vector floor(scale * x), as longs; rows with a null id, a null vector or a null
    or non-finite component are left out."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        rows.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .where(F.coalesce(finite, F.lit(False)))
        .select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
    )


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Doubles hold the products exactly while they stay below 2**53."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors.tolist()])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher score first, then smaller id. Ties at the cut are looked at."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        among = np.flatnonzero(scores >= cut)
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], -scores[among]))][:k]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray,
    vectors: np.ndarray, ids: np.ndarray, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query that the bucket can serve: its id, and scores and ids of its k best here.

    ``floors`` are scores that answers must reach (-inf: none). The query's own row is no
    answer.
    """
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    longest = lengths.max()
    for q, query_id, floor in zip(queries, query_ids.tolist(), floors.tolist(), strict=True):
        size = np.sqrt((q * q).sum())
        bound = size * longest
        if floor > bound * (1 + 1e-9):
            continue
        rows: np.ndarray | slice = slice(None)
        if floor > 0 and bound > 0:
            cosine = floor / bound
            if cosine >= COORDINATE_COSINE:
                # On the query's strongest coordinates F, a vector v reaches at most
                # q_F . v_F + |q_rest| * |v_rest| (Cauchy-Schwarz).
                focus = np.argsort(-np.abs(q))[:FOCUS]
                part = vectors[:, focus]
                near = part @ q[focus]
                rest_q = np.sqrt(max(0.0, size**2 - (q[focus] ** 2).sum()))
                rest_v = np.sqrt(np.maximum(0.0, lengths**2 - (part * part).sum(axis=1)))
                rows = np.flatnonzero(near + rest_q * rest_v >= floor - 1e-6 * (1 + abs(floor)))
            else:
                rows = np.flatnonzero(lengths * size >= floor - 1e-6 * (1 + abs(floor)))
        left_ids = ids[rows]
        scores = vectors[rows] @ q
        fit = (left_ids != query_id) & (scores >= floor)
        scores, left_ids = scores[fit], left_ids[fit]
        top = _best(scores, left_ids, k)
        if len(top):
            yield query_id, scores[top].astype(np.int64), left_ids[top]


def _as_batch(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({"query_id": [], "score": [], "vec_id": []}).astype("int64")
    return pd.DataFrame(
        {
            "query_id": np.concatenate([np.full(len(s), q, np.int64) for q, s, _ in found]),
            "score": np.concatenate([s for _, s, _ in found]),
            "vec_id": np.concatenate([i for _, _, i in found]),
        }
    )


def exact_top_k(vectors: DataFrame, is_query: str, k: int = 20) -> DataFrame:
    """The k largest integer inner products of every query row with all other rows.

    ``vectors`` has ``vec_id`` and ``v`` (see ``integer_vectors``); ``is_query`` is a condition
    on ``vec_id``. Returns query_id, rank (from 1), vec_id, score; ties go to the smaller
    vec_id; fewer rows where fewer candidates exist. Rows of the same id are never each other's
    answers; repeated rows of other ids are answers of their own, a repeated query id is one
    query (its smallest vector). All vectors must have one number of components; the products
    must stay below 2**53. No rows or no queries give no rows.

    Buckets and query blocks hold a fixed number of rows whatever the lengths are, so equal
    vectors spread over buckets. A task joins one bucket with one block of queries; it returns
    at most k rows a query.
    """
    length = F.aggregate("v", F.lit(0).cast("long"), lambda total, x: total + x * x)
    sized = stored(vectors.withColumn("length2", length), "mips-vectors")
    # Ranges of (length, id), cut evenly by the range exchange: buckets of nearly equal length.
    n_buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    ranged = sized.repartitionByRange(n_buckets, F.col("length2").desc(), "vec_id", F.xxhash64("v"))
    buckets = stored(ranged.withColumn("bucket", F.spark_partition_id()), "mips-buckets")
    sizes = stored(buckets.groupBy("bucket").agg(F.max("length2").alias("most")), "mips-sizes")
    asked = sized.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")
    asked = stored(asked.withColumn("block", block), "mips-queries")
    in_blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")

    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _as_batch([])
        floors = left["floor"].to_numpy(dtype=np.float64)
        found = search_block(
            _matrix(left["v"]), left["query_id"].to_numpy(), np.nan_to_num(floors, nan=-np.inf),
            _matrix(right["v"]), right["vec_id"].to_numpy(), k,
        )
        return _as_batch(list(found))

    def searched(queries: DataFrame, held: DataFrame) -> DataFrame:
        copies = held.select(in_blocks, "bucket", "vec_id", "v")
        sides = queries.groupBy("block", "bucket").cogroup(copies.groupBy("block", "bucket"))
        return sides.applyInPandas(task, _HITS)

    longest = sizes.agg(F.min("bucket").alias("bucket"))
    open_floor = F.lit(None).cast("double").alias("floor")
    everywhere = sizes.select(in_blocks, "bucket", "most")
    begin = asked.join(everywhere.join(longest, "bucket", "left_semi"), "block")
    seen = stored(
        searched(
            begin.select("block", "bucket", "query_id", "v", open_floor),
            buckets.join(longest, "bucket", "left_semi"),
        ),
        "mips-first",
    )
    kth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = (
        seen.withColumn("place", F.row_number().over(kth)).where(F.col("place") == k)
        .select("query_id", F.col("score").cast("double").alias("floor"))
    )
    own = F.aggregate("v", F.lit(0).cast("long"), lambda total, x: total + x * x).cast("double")
    others = everywhere.join(longest, "bucket", "left_anti")
    rest = asked.join(floors, "query_id", "left").join(others, "block")
    # The same bound search_block has; here it saves moving the query to the bucket.
    reach = F.sqrt(own * F.col("most")) * (1 + 1e-9)
    rest = rest.where(F.col("floor").isNull() | (F.col("floor") <= reach))
    more = searched(
        rest.select("block", "bucket", "query_id", "v", "floor"),
        buckets.join(longest, "bucket", "left_anti"),
    )
    ranked = seen.unionByName(more).withColumn("rank", F.row_number().over(kth))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
