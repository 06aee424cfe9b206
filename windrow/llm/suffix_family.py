"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

The index of a set of documents is a sparse suffix array: the suffixes at content-defined
anchors (see ``anchors``), one for each distinct context, sorted by head and context (by hashes
of their bytes: only equality matters for long matches). Documents come in batches by ascending
id. A batch gets its suffix array, is merge-scanned against the levels of the family, and joins
it; levels of similar size are merged, so n batches leave about log2(n) levels.

A suffix whose whole context stands earlier is repeated in all its windows. Where only the head
stands earlier, the windows themselves are compared: the contexts of such suffixes are fetched
from the texts, cut to the parts of the windows that another context shares, and windows are
matched by their hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.anchors import HEAD, LENGTH, Fingerprints, find_anchors
from windrow.llm.common import filter_place, id_filter, in_slices, passes, released, stored
from windrow.llm.shingles import mix

#: Bytes of texts that are joined for one pass of numpy.
_BYTES_AT_ONCE = 1 << 18
#: Windows around an anchor are looked at in groups of this many places.
CELL = 16
_ENTRIES = "head bigint, context bigint, doc bigint, place bigint"
#: ``place`` packs the first window's start and the number of windows.
_COUNT_BITS = 7
#: Heads need not be told apart for sure, so a part of their hash is enough.
_HEAD_BITS = np.uint64((1 << 48) - 1)
#: Null ids come first.
_NO_ID = -(2**63)


def _documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID))
    return docs.select(key.alias("doc"), text.alias("text"))


def _joined(keys: list, texts: list[bytes]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Groups of texts of about _BYTES_AT_ONCE, each with its keys, bytes and sizes."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= _BYTES_AT_ONCE or at == len(texts) - 1:
            some = texts[first : at + 1]
            yield keys[first : at + 1], np.frombuffer(b"".join(some), np.uint8), np.array([len(t) for t in some])
            first, size = at + 1, 0


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        for keys, data, sizes in _joined(batch.column(0).to_pylist(), _bytes(batch.column(1))):
            text, first, windows, head, context = find_anchors(Fingerprints(data), sizes)
            columns = [
                (head & _HEAD_BITS).view(np.int64), context.view(np.int64), np.array(keys, dtype=np.int64)[text],
                (first << _COUNT_BITS) | windows,
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["head", "context", "doc", "place"]
            )


def suffix_array(docs: DataFrame) -> DataFrame:
    """All anchored suffixes of ``docs`` (doc, text), not yet sorted."""
    return docs.mapInArrow(released(_entries), _ENTRIES)


def merge_scan(batch: DataFrame, levels: list[DataFrame], keep: bool, name: str) -> DataFrame:
    """Sorts a batch's suffixes together with the levels and scans them.

    Returns (stored) rows with ``kind``: "repeat" for suffixes of the batch whose context stands
    earlier, "look" for the first suffixes of contexts whose head has another context too, if
    the batch has one of them, and, if ``keep``, "level" for the batch's own first suffixes.
    """
    rows = batch.withColumn("new", F.lit(True))
    for level in levels:
        rows = rows.unionByName(level.withColumn("new", F.lit(False)))
    rows = rows.repartition("head")
    same_context = Window.partitionBy("head", "context").orderBy("doc", "place")
    same_head = Window.partitionBy("head")
    scanned = rows.withColumn("first", F.row_number().over(same_context) == 1)
    firsts = F.sum(F.col("first").cast("int")).over(same_head)
    fresh = F.sum((F.col("first") & F.col("new")).cast("int")).over(same_head)
    scanned = scanned.withColumn("look", (firsts > 1) & (fresh > 0) & F.col("first"))
    kinds = F.array_compact(
        F.array(
            F.when(F.col("new") & ~F.col("first"), "repeat"),
            F.when(F.col("look"), "look"),
            F.when(F.col("new") & F.col("first"), "level") if keep else F.lit(None).cast("string"),
        )
    )
    found = scanned.select(F.explode(kinds).alias("kind"), "head", "context", "doc", "place")
    # Only a level needs the hashes later.
    found = found.select(
        "kind", *[F.when(F.col("kind") == "level", F.col(c)).alias(c) for c in ("head", "context")],
        "doc", "place",
    )
    return stored(found, name)


class SuffixFamily:
    """Levels of suffix arrays; ``sizes`` counts the batches in each, largest first."""

    def __init__(self) -> None:
        self.levels: list[DataFrame] = []
        self.sizes: list[int] = []

    def add(self, docs: DataFrame, keep: bool = True) -> DataFrame:
        """Scans a batch of later documents (doc, text) against the family and adds it.

        Without ``keep`` the batch is scanned but not indexed (the last one of a job).
        """
        found = merge_scan(suffix_array(docs), self.levels, keep, "suffix-scan")
        if keep:
            self.levels.append(found.where("kind = 'level'").drop("kind"))
            self.sizes.append(1)
            while len(self.sizes) > 1 and self.sizes[-1] == self.sizes[-2]:
                merged = self.levels[-2].unionByName(self.levels[-1])
                self.levels[-2:] = [stored(merged.repartition("head").sortWithinPartitions("head", "context"), "suffix-level")]
                self.sizes[-2:] = [2 * self.sizes[-1]]
        return found.where("kind <> 'level'")


def _first_window(place: Column) -> Column:
    return F.shiftright(place, _COUNT_BITS)


def _n_windows(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << _COUNT_BITS) - 1))


_CONTEXTS = "doc bigint, place bigint, context binary"


def _contexts(docs: DataFrame, looks: DataFrame) -> DataFrame:
    """The bytes of the windows of each suffix to look at (doc, place)."""
    wanted = looks.groupBy("doc").agg(F.collect_set("place").alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = []
            for doc, text, places in zip(
                batch.column(0).to_pylist(), _bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True
            ):
                for place in places:
                    first, count = place >> _COUNT_BITS, place & ((1 << _COUNT_BITS) - 1)
                    if first + count + LENGTH - 1 <= len(text):
                        rows.append((doc, place, text[first : first + count + LENGTH - 1]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))],
                    names=["doc", "place", "context"],
                )

    # An id with several texts may have several contexts at one place: all of them are looked at.
    likely = _with_ids_of(docs, wanted)
    return likely.join(wanted, "doc").select("doc", "text", "places").mapInArrow(released(cut), _CONTEXTS)


def _with_ids_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents (doc, text) whose id is in ``ids``, and a few more: it spares most of the
    others the shuffle of the join that follows."""
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(ids, "doc"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(bits.value, batch.column(2).to_numpy()))).select([0, 1])

    return docs.withColumn("filter_place", filter_place("doc")).mapInArrow(released(some), "doc bigint, text string")


_CELLS = "cell bigint, doc bigint, place bigint"
_WINDOWS = "doc bigint, start bigint, window bigint"


def _cells_of(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, Fingerprints, np.ndarray]]:
    """For contexts, in groups: their rows, and for each window its row, start and cell.

    A cell has the windows in which the anchor stands in the same CELL places. Its hash is that
    of the bytes all such windows have in common, so windows can be equal only if cells are.
    """
    for batch in in_slices(batches, 2048):
        rows = list(range(batch.num_rows))
        for some, data, sizes in _joined(rows, batch.column(2).to_pylist()):
            prints = Fingerprints(data)
            bases, counts = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
            anchors = _anchor_places(prints, bases)
            row = np.repeat(np.arange(len(some)), counts)
            shift = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            number = (anchors[row] - shift) // CELL
            common = prints.of(bases[row] + anchors[row] - CELL * number, LENGTH - CELL + 1)
            cell = mix(common + number.astype(np.uint64)).view(np.int64)
            yield batch.slice(some[0], len(some)), row, shift, cell, prints, bases


def _window_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of each context."""
    for rows, row, _, cell, _, _ in _cells_of(batches):
        new = np.append(True, (row[1:] != row[:-1]) | (cell[1:] != cell[:-1]))
        at = pa.array(row[new])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell[new]), rows.column(0).take(at), rows.column(1).take(at)],
            names=["cell", "doc", "place"],
        )


def _cell_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the listed cells (fourth column) of each context."""
    for rows, row, shift, cell, prints, bases in _cells_of(batches):
        lists = rows.column(3)
        owner = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
        wanted = lists.flatten().to_numpy()
        # A cell that is listed for one context of the group may be looked at in another too.
        keep = np.isin(cell ^ row, wanted ^ owner) & np.isin(cell, wanted)
        row, shift = row[keep], shift[keep]
        windows = prints.of(bases[row] + shift, LENGTH).view(np.int64)
        starts = (rows.column(1).to_numpy() >> _COUNT_BITS)[row] + shift
        yield pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(row)), pa.array(starts), pa.array(windows)],
            names=["doc", "start", "window"],
        )


def _anchor_places(prints: Fingerprints, bases: np.ndarray) -> np.ndarray:
    """The anchor of each context, from its start: that of its first window."""
    places = bases[:, None] + np.arange(LENGTH - HEAD + 1)
    heads = prints.of(places.reshape(-1), HEAD).reshape(places.shape) >> np.uint64(28)
    return heads.argmin(axis=1)


def repeated_windows(docs: DataFrame, looks: DataFrame) -> DataFrame:
    """doc and start of the windows of the looked-at suffixes that stand earlier."""
    contexts = stored(_contexts(docs, looks), "suffix-contexts")
    cells = stored(contexts.mapInArrow(released(_window_cells), _CELLS), "suffix-cells")
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell")
    listed = cells.join(shared, "cell", "left_semi").groupBy("doc", "place").agg(
        F.collect_set("cell").alias("cells")
    )
    some = contexts.join(listed, ["doc", "place"]).select("doc", "place", "context", "cells")
    windows = stored(some.mapInArrow(released(_cell_windows), _WINDOWS), "suffix-windows")
    earliest = windows.groupBy("window").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")
    ).where("n > 1").select("window", "first")
    later = windows.join(earliest, "window").where(F.struct("doc", "start") > F.col("first"))
    return later.select("doc", "start")


_RESULT = (
    "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
)


def merge_spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as sorted maximal runs; adjacent intervals are one run."""
    if len(begins) == 0:
        return begins, ends
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.append(True, begins[1:] > reach[:-1])
    return begins[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _removed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        rows = []
        for doc, text, spans in zip(
            batch.column(0).to_pylist(), _bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True
        ):
            pairs = np.array([(s["begin"], s["end"]) for s in spans], dtype=np.int64).reshape(-1, 2)
            begins, ends = merge_spans(pairs[:, 0], np.minimum(pairs[:, 1], len(text)))
            gaps = zip(np.append(0, ends).tolist(), np.append(begins, len(text)).tolist(), strict=True)
            kept = b"".join([text[a:b] for a, b in gaps])
            digest = hashlib.sha256(kept).hexdigest()
            rows.append((doc, len(text), len(text) - len(kept), len(begins), digest, kept if with_text else None))
        if rows:
            kinds = (pa.int64(),) * 4 + (pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )


def repeated_spans(docs: DataFrame, cuts: Sequence[float] = (0.5,)) -> DataFrame:
    """doc, begin and end (in bytes) of runs to remove; runs of a document may overlap.

    ``docs`` has doc and text. It is taken in batches of ascending ids, cut at these shares of
    the rows (by approximate quantiles of the ids; any cut gives the same result).
    """
    cuts = docs.approxQuantile("doc", list(cuts), 0.001) if cuts else []
    bounds = [None, *sorted({int(c) for c in cuts}), None]
    family, found = SuffixFamily(), []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        part = docs
        if low is not None:
            part = part.where(F.col("doc") >= low)
        if high is not None:
            part = part.where(F.col("doc") < high)
        found.append(family.add(part, keep=high is not None))
    found = reduce(DataFrame.unionByName, found)
    repeats = found.where("kind = 'repeat'").select(
        "doc", _first_window(F.col("place")).alias("begin"),
        (_first_window(F.col("place")) + _n_windows(F.col("place")) - 1 + LENGTH).alias("end"),
    )
    looks = found.where("kind = 'look'").select("doc", "place")
    windows = repeated_windows(docs, looks)
    return repeats.unionByName(windows.select("doc", F.col("start").alias("begin"), (F.col("start") + LENGTH).alias("end")))


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    cuts: Sequence[float] = (0.5,), with_text: bool = False,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes that stay) of
    every row.

    A byte goes if a 100-byte string that covers it also starts earlier: at a smaller id, or in
    the same text at an earlier place. Strings are judged on the input and never cross texts.
    Null texts and texts of fewer than 100 bytes lose nothing. A null id is the smallest; rows
    that share an id count as one text laid on another: their strings are earlier where they
    start earlier, and they lose the same places. No rows give no rows; other columns are not
    read. Strings are told apart by 64-bit hashes.
    """
    texts = _documents(docs, id_column, text_column)
    spans = stored(repeated_spans(texts, cuts), "suffix-spans")
    gone = spans.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    spoilt = spans.select("doc").distinct()
    cut = _with_ids_of(texts, spoilt).join(gone, "doc").select("doc", "text", "spans").mapInArrow(
        released(lambda b: _removed(b, with_text)), _RESULT
    )
    # Digested before the join, so that texts are not shuffled for it.
    whole = texts.select(
        "doc", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
        (F.col("text") if with_text else F.lit(None)).cast("binary").alias("kept"),
    ).join(spoilt, "doc", "left_anti")
    key = F.when(F.col("doc") != _NO_ID, F.col("doc")).alias(id_column)
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    return cut.unionByName(whole).select(key, *columns)
