"""Token ids of documents as files of patched frame-of-reference segments.

A token file is a Parquet folder whose rows are self-contained segments (see
``frame_of_reference``) with their place: ``part`` and ``seq`` give the order, ``first`` the
ids that stand before the segment in its part. Spark's commit protocol makes the write safe
against lost executors; a reader needs only the segments of the documents it wants.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrow.llm import frame_of_reference as pfor
from windrow.llm.anchors import Fingerprints
from windrow.llm.common import CACHES, released

SEGMENT_IDS = 1 << 20
#: Encoded chunks a worker keeps, about 40 bytes each. Frequent chunks come early.
CACHE_ENTRIES = 700_000
#: Newer chunks: they join the others while there is room, then make way for still newer ones.
RECENT_ENTRIES = 100_000
#: Documents encoded together.
ENCODE_DOCS = 128
_SEGMENTS = "part int, seq int, first bigint, n_docs bigint, n_ids bigint, segment binary"
_DIGESTS = "part int, in_part bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
_IDS = "part int, in_part bigint, doc_id bigint, ids array<bigint>"
#: Bytes that may follow a space at which a chunk starts: neither white space nor the first byte
#: of white space beyond ASCII. The byte-level pre-tokenizer starts a piece at such a space in
#: any text, so the chunks between them can be encoded alone.
_MAY_FOLLOW = np.ones(256, dtype=bool)
_MAY_FOLLOW[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_SPACE = 32
_ANY_SPACE = re.compile(r"\s")
#: How byte-level vocabularies write a space and a newline.
_SPACE_MARK, _NEWLINE_MARK = "\u0120", "\u010a"


class _Chunks:
    """Ids of chunks by the chunks' 64-bit hashes, in two sorted tables."""

    def __init__(self) -> None:
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = self.kept = 0
        nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.tables = [nothing, nothing]

    def __len__(self) -> int:
        return sum(len(t[0]) for t in self.tables)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start in the pool (-1: unknown) and number of ids of each hash."""
        start, count = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        for known, starts, counts in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                start[hit], count[hit] = starts[at[hit]], counts[at[hit]]
        return start, count

    def add(self, hashes: np.ndarray, ids: list[np.ndarray]) -> None:
        """New hashes in ascending order, with their ids."""
        counts = np.array([len(i) for i in ids], dtype=np.int64)
        total = int(counts.sum())
        if self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool) + total, np.uint32)])
        self.pool[self.used : self.used + total] = np.concatenate(ids)
        new = (hashes, self.used + np.cumsum(counts) - counts, counts)
        self.used += total
        self.tables[1] = _merged(self.tables[1], new)

    def settle(self) -> None:
        """Between batches: empties the table of newer chunks once it is full."""
        if len(self.tables[1][0]) > RECENT_ENTRIES:
            if len(self.tables[0][0]) < CACHE_ENTRIES:
                self.tables[0], self.kept = _merged(*self.tables), self.used
            self.tables[1] = tuple(c[:0] for c in self.tables[1])
            self.used = self.kept


def _merged(a: tuple, b: tuple) -> tuple:
    order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
    return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b, strict=True))


class ChunkEncoder:
    """Encodes texts with a tokenizer, each distinct chunk once.

    The ids equal those of ``Tokenizer.encode(text, add_special_tokens=False)``: texts that hold
    an added token's text are one chunk, others are cut where no merge crosses. Chunks are told
    apart by 64-bit hashes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        self.starts = np.array([t.startswith(_SPACE_MARK) for t in tokens])
        self.newline = self.tokenizer.token_to_id(_NEWLINE_MARK)
        self.chunks = _Chunks()

    def _ids(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=np.uint32)

    def _cut(self, text: str, n_chunks: int, at_newlines: bool) -> list[np.ndarray] | None:
        """Encodes chunks that stand one after another in ``text`` and cuts the ids: at newlines
        put before each, or before each token that starts with a space."""
        coded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(coded[0].ids, dtype=np.uint32)
        cuts = np.flatnonzero(ids == self.newline if at_newlines else self.starts[ids])
        if len(cuts) != n_chunks:
            return None
        ends, skip = np.append(cuts[1:], len(ids)).tolist(), int(at_newlines)
        return [ids[a + skip : b] for a, b in zip(cuts.tolist(), ends, strict=True)]

    def _encode_chunks(self, chunks: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(chunks)
        spaced = [i for i, c in enumerate(chunks) if c[0] == " " and c.rfind(" ") == 0]
        bare = [i for i, c in enumerate(chunks) if c[0] != " " and not _ANY_SPACE.search(c)]
        for places, text in (
            (spaced, "".join([chunks[i] for i in spaced])),
            (bare, "\n".join(["", *[chunks[i] for i in bare]])),
        ):
            cut = self._cut(text, len(places), places is bare) if places else None
            for i, ids in zip(places, cut or [], strict=cut is not None):
                out[i] = ids
        return [self._ids(c) if ids is None else ids for c, ids in zip(chunks, out, strict=True)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and their number for each text."""
        parts = [t.encode() for t in texts]
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        is_start = (data == _SPACE) & _MAY_FOLLOW[np.append(data[1:], 0)]
        is_start[ends[sizes > 0] - 1] = False
        for i, text in enumerate(texts):
            if self.added.search(text):
                is_start[begins[i] : ends[i]] = False
        is_start[begins[sizes > 0]] = True
        starts = np.flatnonzero(is_start)
        lengths = np.diff(np.append(starts, len(data)))
        hashes = Fingerprints(data).of(starts, lengths) + lengths.astype(np.uint64)
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        self.chunks.settle()
        place, count = self.chunks.find(distinct)
        new = np.flatnonzero(place < 0)
        if len(new):
            raw = data.tobytes()
            at, to = starts[example[new]], starts[example[new]] + lengths[example[new]]
            some = [raw[a:b].decode() for a, b in zip(at.tolist(), to.tolist(), strict=True)]
            self.chunks.add(distinct[new], self._encode_chunks(some))
            place[new], count[new] = self.chunks.find(distinct[new])
        counts = count[which]
        first = np.cumsum(counts) - counts
        ids = self.chunks.pool[np.repeat(place[which] - first, counts) + np.arange(counts.sum())]
        total = np.append(0, np.cumsum(counts))
        chunk_ends = np.searchsorted(starts, ends)
        return ids, np.diff(np.append(0, total[chunk_ends]))


@lru_cache(maxsize=4)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


CACHES["token_files"] = _encoder.cache_clear


def write_token_file(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int,
    id_column: str = "doc_id", text_column: str = "text", percentile: float = 0.95,
) -> None:
    """Encodes every whole text, appends ``end_id``, and writes the ids by ascending id.

    A null text counts as empty (only the end id); null ids come first; rows that share an id
    follow one another by their texts, and repeated rows are all kept. No rows write an empty
    file. Other columns are not read. The tokenizer's file must be at ``tokenizer_path`` on
    every executor. Texts are shuffled once, by ranges of the id and a hash of the text, so a
    hot id is split; a task holds one Arrow batch and one segment at a time.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer_path), TaskContext.get().partitionId()
        seq, first = 0, 0
        ids: list[np.ndarray] = []
        keys: list[int | None] = []
        sizes: list[int] = []

        def flush() -> pa.RecordBatch:
            given = np.array([k is not None for k in keys], dtype=np.uint8)
            doc_ids = np.array([k or 0 for k in keys], dtype=np.int64)
            lengths = np.array(sizes, dtype=np.uint64)
            data = pfor.encode(pfor.Segment(doc_ids, given, lengths, np.concatenate(ids)), percentile)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                    pa.array([first], pa.int64()), pa.array([len(keys)], pa.int64()),
                    pa.array([sum(sizes)], pa.int64()), pa.array([data], pa.binary()),
                ],
                names=["part", "seq", "first", "n_docs", "n_ids", "segment"],
            )

        for whole in batches:
            for at in range(0, whole.num_rows, ENCODE_DOCS):
                batch = whole.slice(at, ENCODE_DOCS)
                coded, counts = encoder.encode(batch.column(1).to_pylist())
                ids.append(np.insert(coded, np.cumsum(counts), end_id))
                keys += batch.column(0).to_pylist()
                sizes += (counts + 1).tolist()
                if sum(sizes) >= SEGMENT_IDS:
                    yield flush()
                    seq, first = seq + 1, first + sum(sizes)
                    ids, keys, sizes = [], [], []
        if keys:
            yield flush()

    made = ordered.drop("_tie").mapInArrow(released(segments, "token_files"), _SEGMENTS)
    made.write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, first, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            segment = pfor.decode(data)
            ends = np.cumsum(segment.lengths.astype(np.int64))
            starts = ends - segment.lengths.astype(np.int64)
            keys = pa.array(segment.doc_ids, mask=segment.given == 0)
            parts = pa.array(np.full(len(ends), part, np.int32))
            columns = {"part": parts, "in_part": pa.array(starts + first), "doc_id": keys}
            ids = segment.ids.astype("<u4")
            if digest:
                columns["n_tokens"] = pa.array(ends - starts)
                view = memoryview(ids.tobytes())
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
                columns["ids_crc32"] = pa.array(sums, pa.int64())
            else:
                offsets = pa.array(np.append(starts, ends[-1:]), pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    file = spark.read.schema(_SEGMENTS).parquet(path)
    totals = file.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    # One row for each part of the file, so a few thousand at most.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    segments = file.select("part", "first", "segment")
    found = segments.mapInArrow(
        released(lambda batches: _documents(batches, digest), "token_files"), _DIGESTS if digest else _IDS
    )
    start = (F.col("_base") + F.col("in_part")).alias("start")
    rest = ["n_tokens", "ids_crc32"] if digest else ["ids"]
    return found.join(bases, "part").select("doc_id", start, *rest)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids of every document of the file."""
    return _read(spark, path, digest=False)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian uint32), read back
    from the file. Decoding and digesting happen in the same task, so ids are not moved."""
    return _read(spark, path, digest=True)
