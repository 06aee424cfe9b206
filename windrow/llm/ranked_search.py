"""Ranked lexical search without random access: impact-sorted lists, score intervals.

Documents are cut into shards. A shard sorts the postings of the query terms by impact, and each
item reads its terms' lists from the top down, all at the same depth. What it has read of a
document gives the lower end of its score; what unread lists can still add gives the upper end.
Reading goes on until every document that can reach the item's k-th score is known exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrow.llm.common import stored

#: Terms of the items that are searched in one scan, each item's own; one with more goes alone.
TERMS_AT_ONCE = 200_000
#: Postings that make a shard full; a document is never cut.
SHARD_POSTINGS = 1 << 20
#: Entries of each list in the first read; every further read doubles them.
FIRST_READ = 256
_POSTINGS = "doc_id bigint, n_terms bigint, terms array<int>, times array<int>"
_FOUND = "item int, doc_id bigint, score bigint"
#: Lower case for A-Z and a space for every ASCII character that is no letter or digit. Bytes of
#: UTF-8 from 128 on belong to characters beyond ASCII, which are all parts of terms.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM_BYTES).split()


def weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def impacts(times: np.ndarray, lengths: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """What a term's occurrences count in a document of so many terms, before its weight."""
    if 90 * n_docs * int(lengths.max(initial=0)) < 2**63:
        m = 10 + 90 * lengths * n_docs // all_terms
    else:
        m = np.array([10 + 90 * n * n_docs // all_terms for n in lengths.tolist()], dtype=np.int64)
    return 1_000_000_000 * times // (1000 * times + 8 * m)


@dataclass
class Best:
    """An item's best documents so far: at most k, best first."""

    scores: np.ndarray
    given: np.ndarray
    doc_ids: np.ndarray

    def floor(self, k: int) -> int:
        """A document below this score is not among the best."""
        return int(self.scores[k - 1]) if len(self.scores) >= k else 1

    def with_more(self, k: int, scores: np.ndarray, given: np.ndarray, ids: np.ndarray) -> Best:
        every = [np.concatenate(p) for p in zip((self.scores, self.given, self.doc_ids), (scores, given, ids), strict=True)]
        order = np.lexsort((every[2], every[1], -every[0]))[:k]
        return Best(*(column[order] for column in every))


def no_best() -> Best:
    return Best(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))


class Shard:
    """Impact-sorted lists of the documents of one shard."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impact: np.ndarray, n_docs: int):
        order = np.lexsort((-impact, terms))
        self.terms, self.docs, self.impact = terms[order], docs[order], impact[order]
        self.n_docs = n_docs

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        low, high = np.searchsorted(self.terms, terms), np.searchsorted(self.terms, terms, side="right")
        return [(self.docs[a:b], self.impact[a:b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents whose score reaches ``floor`` and the shard's own k-th score, their scores,
        and the number of entries read. All of them are exact, ties at the end included."""
        found = zip(self.lists(terms), weights.tolist(), strict=True)
        lists = [(docs, impact, w) for (docs, impact), w in found if w > 0 and len(docs)]
        low = np.zeros(self.n_docs, dtype=np.int64)
        depth, step = 0, FIRST_READ
        while True:
            bounds = []
            for docs, impact, w in lists:
                low[docs[depth : depth + step]] += w * impact[depth : depth + step]
                bounds.append(w * int(impact[depth + step]) if depth + step < len(docs) else 0)
            depth, step = depth + step, step * 2
            unread = sum(bounds)
            if k <= self.n_docs:
                floor = max(floor, int(np.partition(low, self.n_docs - k)[self.n_docs - k]))
            if unread >= floor:
                continue  # a document that no list has shown yet may still be among the best
            maybe = np.flatnonzero(low + unread >= floor)
            high = np.full(self.n_docs, unread, dtype=np.int64)
            for (docs, _, _), bound in zip(lists, bounds, strict=True):
                if bound:
                    high[docs[:depth]] -= bound
            maybe = maybe[(low + high)[maybe] >= floor]
            if not high[maybe].any():
                maybe = maybe[low[maybe] >= floor]
                return maybe, low[maybe], sum(min(depth, len(docs)) for docs, _, _ in lists)


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n_terms (with repeats), and the vocabulary's terms in it with their occurrences;
    one row for each row of ``docs`` (doc_id, text)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sizes, terms, times = [], [], []
                for text in batch.column(1).to_pylist():
                    found = Counter(terms_of(text))
                    sizes.append(found.total())
                    known = [(vocabulary[t], n) for t, n in found.items() if t in vocabulary]
                    terms.append([t for t, _ in known])
                    times.append([n for _, n in known])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(sizes, pa.int64()),
                        pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n_terms", "terms", "times"],
                )

    return docs.mapInArrow(counted, _POSTINGS)


def _search_shards(
    batches: Iterator[pa.RecordBatch], items: list[np.ndarray], weights: np.ndarray, k: int,
    n_docs: int, all_terms: int, shard_postings: int,
) -> Iterator[pa.RecordBatch]:
    """The best documents of each item among the rows of one task, shard by shard; an item's k-th
    score so far is where the next shard's documents have to start."""
    best = [no_best() for _ in items]
    held: list[pa.RecordBatch] = []
    size = 0

    def search() -> None:
        rows = pa.Table.from_batches(held).combine_chunks()
        counts = pc.list_value_length(rows["terms"]).to_numpy()
        terms = rows["terms"].combine_chunks().flatten().to_numpy()
        times = rows["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        impact = impacts(times, rows["n_terms"].to_numpy()[owner], n_docs, all_terms)
        shard = Shard(terms, owner, impact, len(counts))
        given = rows["doc_id"].is_valid().to_numpy()
        doc_ids = rows["doc_id"].fill_null(0).to_numpy()
        for number, own in enumerate(items):
            found, scores, _ = shard.search(own, weights[own], k, best[number].floor(k))
            if len(found):
                best[number] = best[number].with_more(k, scores, given[found], doc_ids[found])

    for batch in batches:
        counts = pc.list_value_length(batch.column(2)).to_numpy().astype(np.int64)
        at, upto = 0, np.cumsum(counts)
        while at < batch.num_rows:
            so_far = int(upto[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(upto, so_far + shard_postings - size, side="right")))
            held.append(batch.slice(at, end - at))
            size += int(upto[end - 1]) - so_far
            at = end
            if size >= shard_postings:
                search()
                held, size = [], 0
    if held:
        search()
    for number, own in enumerate(best):
        if len(own.scores):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(own.scores), number, np.int32)),
                    pa.array(own.doc_ids, mask=~own.given), pa.array(own.scores),
                ],
                names=["item", "doc_id", "score"],
            )


def _blocks(items: DataFrame, at_once: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items that have terms with their distinct terms, in blocks of ``at_once`` terms at most."""
    block, size = [], 0
    for row in items.toLocalIterator():
        own = sorted(set(terms_of(row["text"])))
        if block and size + len(own) > at_once:
            yield block
            block, size = [], 0
        if own:
            block.append((row["item_id"], own))
            size += len(own)
    if block:
        yield block


def _rank_block(
    spark: SparkSession, docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int,
    shard_postings: int,
) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}))}
    found = stored(postings(docs, vocabulary), "postings")
    n_docs, all_terms = found.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    holding = found.select(F.explode("terms").alias("term")).groupBy("term").count()
    # One row for each term of the block at most.
    for row in holding.collect():
        weights[row["term"]] = weight(n_docs, row["count"])
    items = [np.array([vocabulary[t] for t in own], dtype=np.int64) for _, own in block]
    sent = spark.sparkContext.broadcast((items, weights))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search_shards(batches, *sent.value, k, n_docs, all_terms, shard_postings)

    held = found.where("size(terms) > 0").mapInArrow(searched, _FOUND)
    place = F.row_number().over(
        Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    )
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id bigint")
    ranked = held.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id",
    text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text",
    terms_at_once: int = TERMS_AT_ONCE, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``k`` best documents.

    A term is a run of ASCII letters and digits and of any characters beyond ASCII, in lower case as
    far as A-Z go. Documents that score 0 are left out, equal scores go by ascending doc_id (null
    ids first). Null and empty texts have no terms; each row of ``docs`` is a document and each row
    of ``items`` an item, repeated ids included. No documents or no items: no rows. Other columns
    are not read.

    Items are searched in blocks of ``terms_at_once`` terms (these, their weights and the items' ids
    are what is broadcast), each in two scans: one counts terms, the other searches shards of
    ``shard_postings`` postings, whose results are k rows for each item and task. Shards are cut
    from what a task reads, so no term, document or item gathers in one task.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    asked = items.select(
        F.col(item_column).cast("long").alias("item_id"),
        F.col(item_text_column).cast("string").alias("text"),
    )
    found = None
    for block in _blocks(asked, terms_at_once):
        part = _rank_block(spark, rows, block, k, shard_postings)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found
