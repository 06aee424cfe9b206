"""Alignment of two tokenizers' ids over the same texts.

Texts are shuffled by their full text, so each distinct one is encoded and aligned once; what it
adds to the corpus's counts is weighted by its number of copies, and its measures are joined back
to the documents by a digest of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import CACHES, released, stored
from windrow.llm.token_files import ChunkEncoder

#: Characters of texts aligned together, and ids turned into Python objects at once.
ALIGN_CHARS = 1 << 18
IDS_AT_ONCE = 1 << 16
#: Texts whose pairs are looked up together.
ROWS_AT_ONCE = 512
#: Pairs of ids that are sent to the tasks at once, 16 bytes each. All pairs of one id of A go
#: together, so a slice has at most this many or those of one id (B's vocabulary bounds them).
PAIRS_AT_ONCE = 1 << 20
_SEPARATORS = (b",", b"|", b";")
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_ALIGNED = (
    "text_key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, times array<int>"
)
_SUMS = "text_key binary, n_best bigint, count_sum bigint"


def _byte_of_mark() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class PlainEncoder(ChunkEncoder):
    """A byte-level tokenizer to which special tokens' strings are plain text."""

    def __init__(self, path: str):
        import re

        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.added = re.compile(r"(?!)")

    def token_bytes(self) -> list[bytes]:
        byte_of = _byte_of_mark()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        return [
            bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
            for t in tokens
        ]


class PieceEncoder:
    """A piece model with byte fallback, which puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [np.array(ids, dtype=np.uint32) for ids in self.model.encode(texts, num_threads=1)]
        counts = np.array([len(ids) for ids in coded], dtype=np.int64)
        return np.concatenate(coded) if coded else np.zeros(0, np.uint32), counts

    def token_bytes(self) -> list[bytes]:
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        return [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]


@dataclass
class Aligned:
    """What one text has: counts, the digest of its groups, and its distinct pairs of ids (as
    ``a * size_b + b``, ascending) with the number of links of each."""

    counts: tuple[int, int, int, int]
    groups_sha256: str
    pairs: np.ndarray
    times: np.ndarray


_NOTHING = Aligned((0, 0, 0, 0), "", np.zeros(0, np.int64), np.zeros(0, np.int32))


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PlainEncoder(path_a), PieceEncoder(path_b)
        self.bytes_a, self.bytes_b = self.a.token_bytes(), self.b.token_bytes()
        self.sizes_a = np.array([len(t) for t in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], dtype=np.int64)
        self.size_b = len(self.bytes_b)
        largest = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [b"%d%s" % (i, s) for i in range(largest) for s in _SEPARATORS]

    def align(self, texts: list[str]) -> list[Aligned]:
        """Texts that are empty, or that a tokenizer's bytes do not spell, have no tokens."""
        out = [_NOTHING] * len(texts)
        places = [i for i, t in enumerate(texts) if t]
        if not places:
            return out
        whole = [b" " + texts[i].encode() for i in places]
        ids_a, n_a = self.a.encode([" " + texts[i] for i in places])
        ids_b, n_b = self.b.encode([texts[i] for i in places])
        of_a, of_b = np.split(ids_a, np.cumsum(n_a)[:-1]), np.split(ids_b, np.cumsum(n_b)[:-1])
        fits = [
            k for k, data in enumerate(whole)
            if _spells(of_a[k], self.bytes_a, data) and _spells(of_b[k], self.bytes_b, data)
        ]
        if fits:
            found = self._align_ids(
                [of_a[k] for k in fits], [of_b[k] for k in fits], [len(whole[k]) for k in fits]
            )
            for k, one in zip(fits, found, strict=True):
                out[places[k]] = one
        return out

    def _align_ids(
        self, of_a: list[np.ndarray], of_b: list[np.ndarray], sizes: list[int]
    ) -> list[Aligned]:
        """All texts laid out one after another: a text's end is an end of both tokenizers."""
        ids_a, ids_b = np.concatenate(of_a).astype(np.int64), np.concatenate(of_b).astype(np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        text_ends = np.cumsum(np.array(sizes, dtype=np.int64))
        n = len(sizes)
        # Between two neighbouring ends, of whichever tokenizer, exactly one pair overlaps.
        cuts = np.union1d(ends_a, ends_b)
        pairs = ids_a[np.searchsorted(ends_a, cuts)] * self.size_b + ids_b[np.searchsorted(ends_b, cuts)]
        text_of_cut = np.searchsorted(text_ends, cuts)
        span = len(self.bytes_a) * self.size_b
        distinct, times = np.unique(text_of_cut * span + pairs, return_counts=True)
        first = np.searchsorted(distinct, np.arange(n + 1) * span)

        group_ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)
        at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, side="right")
        written = np.zeros(len(ids_a) + len(ids_b), dtype=np.int64)
        written[at_a], written[at_b] = 3 * ids_a, 3 * ids_b
        written[at_a[np.searchsorted(ends_a, group_ends)]] += 1
        written[at_b[np.searchsorted(ends_b, group_ends)]] += 2

        n_groups = np.bincount(np.searchsorted(text_ends, group_ends), minlength=n)
        n_links = np.bincount(text_of_cut, minlength=n)
        out, at = [], 0
        for k in range(n):
            n_a, n_b = len(of_a[k]), len(of_b[k])
            digest = self._digest(written[at : at + n_a + n_b])
            at += n_a + n_b
            own = slice(first[k], first[k + 1])
            out.append(
                Aligned(
                    (n_a, n_b, int(n_groups[k]), int(n_links[k])), digest,
                    distinct[own] - k * span, times[own].astype(np.int32),
                )
            )
        return out

    def _digest(self, written: np.ndarray) -> str:
        """Of the decimal ids with their separators, without the last one."""
        digest = hashlib.sha256()
        for at in range(0, len(written), IDS_AT_ONCE):
            some = b"".join([self.written[i] for i in written[at : at + IDS_AT_ONCE].tolist()])
            digest.update(some[:-1] if at + IDS_AT_ONCE >= len(written) else some)
        return digest.hexdigest()


def _spells(ids: np.ndarray, token_bytes: list[bytes], data: bytes) -> bool:
    start = 0
    for at in range(0, len(ids), IDS_AT_ONCE):
        some = b"".join([token_bytes[i] for i in ids[at : at + IDS_AT_ONCE].tolist()])
        if not data.startswith(some, start):
            return False
        start += len(some)
    return start == len(data)


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


CACHES["alignment"] = _aligner.cache_clear


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.append(0, np.cumsum([len(a) for a in arrays])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays), kind))


def align_texts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each row of ``texts`` (text_key, copies, text): counts, digest and pairs."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            at, sizes = 0, pc.utf8_length(batch.column(2)).to_numpy(zero_copy_only=False)
            upto = np.cumsum(sizes.astype(np.int64))
            while at < batch.num_rows:
                so_far = upto[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(upto, so_far + ALIGN_CHARS, side="right")))
                some = batch.slice(at, end - at)
                found = aligner.align(some.column(2).to_pylist())
                columns = [some.column(0), some.column(1)]
                columns += [pa.array([f.counts[i] for f in found], pa.int64()) for i in range(4)]
                columns += [
                    pa.array([f.groups_sha256 for f in found], pa.string()),
                    _lists([f.pairs for f in found], pa.int64()),
                    _lists([f.times for f in found], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns,
                    names=["text_key", "copies", *_COUNTS, "groups_sha256", "pairs", "times"],
                )
                at = end

    return texts.select("text_key", "copies", "text").mapInArrow(released(aligned, "alignment"), _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n_docs: how many documents hold the pair linked."""
    held = aligned.select(F.explode("pairs").alias("pair"), "copies")
    return held.groupBy("pair").agg(F.sum("copies").alias("n_docs"))


def _slices(pairs: DataFrame, size_b: int, at_once: int) -> list[tuple[int, int]]:
    """Ranges of pairs, cut between ids of A, with at most ``at_once`` pairs (or one id's)."""
    per_id = pairs.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.count("*").alias("n"))
    # One row for each id of A's vocabulary at most.
    counts = sorted((r["a"], r["n"]) for r in per_id.collect())
    starts, held = [], at_once
    for a, n in counts:
        if held + n > at_once:
            starts.append(a * size_b)
            held = 0
        held += n
    ends = [*starts[1:], (counts[-1][0] + 1) * size_b] if counts else []
    return list(zip(starts, ends, strict=True))


def _sums(aligned: DataFrame, pairs: DataFrame, size_b: int, at_once: int) -> DataFrame:
    """text_key, n_best and count_sum, from one slice of the counts after another."""
    spark, found = aligned.sparkSession, None
    rows = aligned.select("text_key", "pairs", "times")
    for low, high in _slices(pairs, size_b, at_once):
        some = pairs.where(F.col("pair").between(low, high - 1)).toArrow()
        known, counts = (some[c].to_numpy() for c in ("pair", "n_docs"))
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        begins = np.flatnonzero(np.diff(known // size_b, prepend=-1))
        highest = np.maximum.reduceat(counts, begins)
        best = counts == np.repeat(highest, np.diff(np.append(begins, len(counts))))
        sent = spark.sparkContext.broadcast((known, counts, best))

        def summed(
            batches: Iterator[pa.RecordBatch], sent=sent, low=low, high=high
        ) -> Iterator[pa.RecordBatch]:
            known, counts, best = sent.value
            for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
                lists, times = batch.column(1), batch.column(2).flatten().to_numpy()
                codes = lists.flatten().to_numpy()
                owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                inside = (codes >= low) & (codes < high)
                codes, times, owner = codes[inside], times[inside].astype(np.int64), owner[inside]
                at = np.searchsorted(known, codes)
                sums = np.zeros((2, batch.num_rows), dtype=np.int64)
                np.add.at(sums[0], owner, times * best[at])
                np.add.at(sums[1], owner, times * counts[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sums[0]), pa.array(sums[1])],
                    names=["text_key", "n_best", "count_sum"],
                )

        part = rows.mapInArrow(summed, _SUMS)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], _SUMS)
    return found.groupBy("text_key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id",
    text_column: str = "text", pairs_at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """How the ids of two tokenizers line up in every document.

    ``path_a`` names a byte-level tokenizer, which reads a space and the text, ``path_b`` a piece
    model, which puts the space itself; both files must be at their paths on every executor. Returns
    doc_id, n_a, n_b (ids of each), n_groups (stretches between bytes where ids of both end),
    n_links (pairs of overlapping ids), n_best (links whose pair is held by as many documents as any
    pair of the same id of A), count_sum (that number, summed over links) and groups_sha256.

    A null or empty text, and one whose ids do not spell it byte for byte, has zeros and an empty
    digest. Repeated rows and null ids are documents like others: every row gives one row. Other
    columns are not read. Texts are told apart in full; measures are joined back by their SHA-256.
    Copies of one text meet as counts, combined before the shuffle, so a text that a third of all
    rows hold is one row for each task; the join back moves ids and digests and is left to adaptive
    execution to split. Pair counts go to the tasks in slices of ``pairs_at_once``.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    digest = F.unhex(F.sha2("text", 256))
    texts = rows.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.select(digest.alias("text_key"), "copies", "text")
    aligned = stored(align_texts(texts, path_a, path_b), "aligned")
    pairs = stored(pair_counts(aligned), "pair-counts")
    size_b = PieceEncoder(path_b).model.get_piece_size()
    sums = _sums(aligned, pairs, size_b, pairs_at_once)
    measures = aligned.select("text_key", *_COUNTS, "groups_sha256").join(sums, "text_key")
    keyed = rows.select("doc_id", F.when(F.col("text") != "", digest).alias("text_key"))
    numbers = [*_COUNTS, "n_best", "count_sum"]
    return keyed.join(measures, "text_key", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
