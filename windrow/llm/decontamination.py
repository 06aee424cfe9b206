"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are TF-IDF vectors (presence times inverse document frequency in the corpus)
over the items' words. A distributed randomised SVD gives the latent space of a block of items;
every passage of the documents is folded into it and compared with the items there. Candidates
are those whose inner product (the cosine times both lengths) reaches the item's bound: the least
that a passage with enough of the item's words can have. They are verified on the word sequences:
by the longest common subsequence and, for paraphrases, by whether the item's answer is there as
well. Blocks are so small that their space spans each item, so no match is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import released, stored
from windrow.llm.shingles import word_hashes

#: Bytes beside white space that part words here.
PUNCTUATION = b".,;:!?\"'()[]"
#: A space has more directions than RANK only if its block by chance has more items.
RANK, OVERSAMPLING, POWER_ROUNDS = 256, 8, 2
#: Directions with less than this share of the strongest one's square are rounding.
LEAST_SQUARE = 1e-13
#: Items of a block on average, searched in one scan of the corpus: fewer than RANK, as rows are
#: dealt to blocks by their hash.
ITEMS_AT_ONCE = 224
#: Share of the item's words in the longest common subsequence: enough alone, and with answer.
VERBATIM_SHARE, PARAPHRASE_SHARE = 0.8, 0.6
#: Share of the answer's words in the longest common subsequence with it.
ANSWER_SHARE = 0.5
_DOCS_AT_ONCE = 256
#: Words whose passages are folded together.
_WORDS_AT_ONCE = 1 << 14
_FOUND = (
    "doc_id bigint, item_id bigint, first_word bigint, cosine double, coverage double, "
    "lcs double, answer double"
)


@dataclass(frozen=True)
class Items:
    """A block of benchmark items: word hashes in order, and the words of the answers."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray

    def columns(self, item: int) -> np.ndarray:
        return np.searchsorted(self.vocabulary, np.unique(self.words[item]))


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes without regard to case (of any script) and punctuation, and words per text."""
    return word_hashes([t.lower() for t in texts], PUNCTUATION)


def _last_sentence(text: str) -> str:
    parts = [p for p in text.replace("!", ".").replace("?", ".").split(".") if p.strip()]
    return parts[-1] if parts else ""


def load_items(rows: list[tuple[int, str, str | None]]) -> Items:
    """Items without words are left out. Without a given answer it is the last sentence."""
    ids, words, answers = [], [], []
    for item_id, text, answer in rows:
        found, _ = _words([text or ""])
        if item_id is None or len(found) == 0:
            continue
        ids.append(item_id)
        words.append(found)
        answers.append(_words([answer or _last_sentence(text)])[0])
    vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    return Items(ids, words, answers, vocabulary)


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))


def _columns_of(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Each word's place in the vocabulary, -1 for words that are not in it."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def inverse_frequencies(texts: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """ln(1 + N / (1 + documents with the word)) for every word of the vocabulary, all
    documents counted."""
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n_docs = np.zeros(size, dtype=np.int64), 0
        for whole in batches:
            for at in range(0, whole.num_rows, _DOCS_AT_ONCE):
                part = whole.column(0).slice(at, _DOCS_AT_ONCE).to_pylist()
                hashes, counts = _words(part)
                found = _columns_of(hashes, vocabulary)
                owner = np.repeat(np.arange(len(part)), counts)[found >= 0]
                pairs = np.unique(owner * size + found[found >= 0])
                total += np.bincount(pairs % size, minlength=size)
                n_docs += len(part)
        word = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(word, pa.int64()), pa.array(np.append(total[word[:-1]], n_docs), pa.int64())],
            names=["word", "n"],
        )

    sums = texts.select("text").mapInArrow(released(count), "word bigint, n bigint")
    found = sums.groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {row["word"]: row["n"] for row in found}
    n_docs = counts.pop(-1, 0)
    often = np.zeros(size)
    often[list(counts)] = list(counts.values())
    return np.log1p(n_docs / (1 + often))


def latent_space(passages: DataFrame, size: int, rank: int = RANK, seed: int = 0) -> np.ndarray:
    """The leading right singular vectors (size x rank) of the matrix of ``passages``.

    Rows are sparse: ``columns array<int>``, ``values array<double>``. Randomised range finder
    with power rounds; each product with the matrix and its transpose is summed over partitions
    by Spark. Only size x rank numbers reach the driver.
    """
    width = min(size, rank + OVERSAMPLING)
    start = np.random.default_rng(seed).standard_normal((size, width))

    def product(basis: np.ndarray) -> np.ndarray:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, width))
            for batch in batches:
                for cols, vals in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    values = np.array(vals)
                    total[cols] += np.outer(values, values @ basis[cols])
            kept = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kept, pa.int64()),
                    pa.array([total[i].tobytes() for i in kept], pa.binary()),
                ],
                names=["row", "numbers"],
            )

        def added(group: pa.Table) -> pa.Table:
            numbers = [np.frombuffer(x) for x in group.column("numbers").to_pylist()]
            return pa.table({"row": group.column("row")[:1], "numbers": [sum(numbers).tobytes()]})

        schema = "row bigint, numbers binary"
        sums = passages.mapInArrow(partial, schema).groupBy("row").applyInArrow(added, schema)
        out = np.zeros((size, width))
        for row in sums.collect():
            out[row["row"]] = np.frombuffer(bytes(row["numbers"]))
        return out

    basis = np.linalg.qr(product(start))[0]
    for _ in range(POWER_ROUNDS - 1):
        basis = np.linalg.qr(product(basis))[0]
    inner = basis.T @ product(basis)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    kept = np.argsort(-values)[: min(rank, width)]
    kept = kept[values[kept] > LEAST_SQUARE * max(values.max(), 1e-300)]
    return basis @ vectors[:, kept]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, with one machine word's bit for each of ``a``."""
    if len(a) == 0 or len(b) == 0:
        return 0
    masks: dict[int, int] = {}
    for place, word in enumerate(a.tolist()):
        masks[word] = masks.get(word, 0) | (1 << place)
    full = (1 << len(a)) - 1
    row = full
    for word in b.tolist():
        match = row & masks.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


@dataclass(frozen=True)
class Index:
    """What the tasks need: the items, the words' weights, and the items in latent space."""

    items: Items
    weights: np.ndarray
    space: np.ndarray
    latent: np.ndarray
    squares: np.ndarray
    #: Each item's distinct words, as sorted columns.
    columns: list[np.ndarray]
    #: Length class of each item: the next power of two of its words.
    sizes: np.ndarray
    #: Words that a passage must have in common with the item.
    least: np.ndarray
    #: Each item's words, as sorted keys: the item times all words, and the word.
    pairs: np.ndarray
    #: How often the word stands in the item.
    times: np.ndarray
    #: What an occurrence of a word adds to its passage: its weighted row of the space and, last,
    #: its weight. Words that no item has come first and add nothing.
    folds: np.ndarray
    #: The items in latent space and, last, what rounding may cost for each unit of weight.
    probes: np.ndarray
    #: Least product of a row of ``probes`` and a passage that may pass.
    bounds: np.ndarray


def _least_product(squares: np.ndarray, times: np.ndarray, missing: int) -> float:
    """The least sum of squares that is left if words that stand ``missing`` times in the item, or
    less, are not in the passage. The last one is taken in part, so it is never too high."""
    order = np.argsort(-squares / times, kind="stable")
    before = np.cumsum(times[order]) - times[order]
    part = np.clip((missing - before) / times[order], 0, 1)
    return float((squares[order] * (1 - part)).sum())


def build_index(items: Items, weights: np.ndarray, space: np.ndarray) -> Index:
    """A passage passes only if it has PARAPHRASE_SHARE of the item's words. With the dearest words
    missing to that, its product with the item, which repeated words only raise, is the item's
    bound. The space holds the items but for directions below LEAST_SQUARE, and products are
    summed in single precision; ``probes`` makes good for both."""
    n = len(items.ids)
    columns = [items.columns(i) for i in range(n)]
    times = [np.unique(w, return_counts=True)[1] for w in items.words]
    latent = np.stack([(weights[c, None] * space[c]).sum(axis=0) for c in columns])
    squares = np.array([(weights[c] ** 2).sum() for c in columns])
    lengths = np.array([len(w) for w in items.words])
    least = np.ceil(PARAPHRASE_SHARE * lengths - 1e-9).astype(np.int64)
    bounds = [_least_product(weights[c] ** 2, t, m) for c, t, m in zip(columns, times, lengths - least, strict=True)]
    sizes = np.array([max(16, 1 << (len(w) - 1).bit_length()) for w in items.words])
    dropped = math.sqrt(n * LEAST_SQUARE * squares.sum())
    rounding = np.finfo(np.float32).eps * (1.5 * sizes + space.shape[1]) * np.sqrt(squares)
    pairs = np.concatenate([item * len(weights) + c for item, c in enumerate(columns)])
    folds = np.zeros((len(weights) + 1, space.shape[1] + 1), np.float32)
    folds[1:, :-1], folds[1:, -1] = weights[:, None] * space, weights
    probes = np.column_stack([latent, dropped + rounding]).astype(np.float32)
    return Index(
        items, weights, space, latent, squares, columns, sizes, least, pairs, np.concatenate(times), folds, probes,
        np.array(bounds) * (1 - 1e-6),
    )


def _folded(found: np.ndarray, begins: np.ndarray, ends: np.ndarray, half: int, index: Index) -> np.ndarray:
    """The sum of ``folds`` over each run of up to ``half`` words."""
    place = begins + np.arange(half)[:, None]
    words = np.where(place < ends, found[np.minimum(place, len(found) - 1)], -1)
    sums = np.zeros((len(begins), index.folds.shape[1]), np.float32)
    row = np.empty_like(sums)
    for word in words:
        np.take(index.folds, word + 1, axis=0, out=row, mode="clip")
        sums += row
    return sums


def _enough(found: np.ndarray, begins: np.ndarray, ends: np.ndarray, item: np.ndarray, index: Index) -> np.ndarray:
    """Whether passages have as many words in common with their items as a match needs. A word
    counts as often as it stands in both."""
    place = begins[:, None] + np.arange(int((ends - begins).max()))
    words = found[np.minimum(place, len(found) - 1)]
    keys = item[:, None] * len(index.weights) + words
    at = np.minimum(np.searchsorted(index.pairs, keys), len(index.pairs) - 1)
    own = (index.pairs[at] == keys) & (words >= 0) & (place < ends[:, None])
    at = np.sort(np.where(own, at, -1), axis=1)
    column = np.broadcast_to(np.arange(at.shape[1]), at.shape)
    fresh = np.ones(at.shape, bool)
    fresh[:, 1:] = at[:, 1:] != at[:, :-1]
    before = column - np.maximum.accumulate(np.where(fresh, column, 0), axis=1)
    return ((at >= 0) & (before < index.times[at])).sum(axis=1) >= index.least[item]


def _near(found: np.ndarray, counts: np.ndarray, index: Index) -> Iterator[tuple[int, int, int]]:
    """(text, item, start) of the passages that reach an item's bound in latent space, and have
    words enough.

    A passage of an item starts at multiples of half its size and is 1.5 sizes long, so any run
    of ``size`` words lies within one. Repeated words count again, so none is left out that
    could pass.
    """
    ends = np.cumsum(counts)
    for size in np.unique(index.sizes).tolist():
        members, half = np.flatnonzero(index.sizes == size), size // 2
        probes, bounds = index.probes[members].T, index.bounds[members]
        halves = -(-counts // half)
        text = np.repeat(np.arange(len(counts)), halves)
        step = np.arange(len(text)) - np.repeat(np.cumsum(halves) - halves, halves)
        begin = (ends - counts)[text] + step * half
        end = np.minimum(begin + half, ends[text])
        at_once = max(1, _WORDS_AT_ONCE // half)
        for at in range(0, len(text), at_once):
            # A passage is its half and the next two of the same text.
            here = slice(at, at + at_once + 2)
            parts, owner = _folded(found, begin[here], end[here], half, index), text[here]
            passages = parts[:at_once].copy()
            for k in (1, 2):
                follows = owner[k : at_once + k] == owner[: max(0, min(at_once, len(owner) - k))]
                passages[: len(follows)] += parts[k : at_once + k] * follows[:, None]
            near, place = np.nonzero(passages @ probes >= bounds)
            near, item = at + near, members[place]
            last = np.minimum(begin[near] + size + half, ends[text[near]])
            for part in range(0, len(near), at_once):
                some = slice(part, part + at_once)
                enough = _enough(found, begin[near[some]], last[some], item[some], index)
                which = near[some][enough]
                yield from zip(
                    text[which].tolist(), item[some][enough].tolist(), (step[which] * half).tolist(), strict=True
                )


def _cosine(words: np.ndarray, item: int, index: Index) -> float:
    """Cosine of a passage's words and an item in latent space."""
    folded, latent = (index.weights[words, None] * index.space[words]).sum(axis=0), index.latent[item]
    return float(latent @ folded) / max(math.sqrt(float(folded @ folded) * float(latent @ latent)), 1e-12)


def search_texts(texts: list[str], index: Index) -> list[tuple]:
    """Verified (text, item, first word, cosine, coverage, lcs, answer); of each item in a text
    the best passage."""
    hashes, counts = _words(texts)
    found = _columns_of(hashes, index.items.vocabulary)
    ends = np.cumsum(counts)
    best: dict[tuple[int, int], tuple] = {}
    for text, item, start in _near(found, counts, index):
        begin = int(ends[text] - counts[text]) + start
        end = min(begin + int(index.sizes[item]) * 3 // 2, int(ends[text]))
        passage, wanted = hashes[begin:end], index.items.words[item]
        shared = common_subsequence(wanted, passage) / len(wanted)
        answer_words = index.items.answers[item]
        answer = common_subsequence(answer_words, passage) / max(1, len(answer_words))
        if shared >= VERBATIM_SHARE or (shared >= PARAPHRASE_SHARE and answer >= ANSWER_SHARE):
            words, own = np.unique(found[begin:end]), index.columns[item]
            coverage = float((index.weights[own[np.isin(own, words)]] ** 2).sum() / index.squares[item])
            row = (shared, _cosine(words[words >= 0], item, index), -start, coverage, answer)
            best[text, item] = max(row, best.get((text, item), row))
    return [
        (text, item, -start, cosine, coverage, lcs, answer)
        for (text, item), (lcs, cosine, start, coverage, answer) in sorted(best.items())
    ]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", answer_column: str | None = None,
) -> DataFrame:
    """(doc_id, item_id) of every benchmark item that stands in a document's text, with the
    first word of the passage, its cosine and coverage, and the shares of the item's and the
    answer's words in the longest common subsequence.

    Whole texts are searched in passages of up to 1.5 times an item's length class. Null texts
    and texts or items without words match nothing; null ids of documents are kept in the
    result, items without an id are left out; repeated rows are all reported; empty tables give
    no rows. Other columns are not read. The benchmark is taken in blocks of about ITEMS_AT_ONCE,
    each a scan of the corpus for its words' frequencies and one for the search; passages are
    compared where they are read, so nothing of the corpus is shuffled.
    """
    spark = docs.sparkSession
    texts = _texts(docs, id_column, text_column)
    answer = F.col(answer_column) if answer_column else F.lit(None).cast("string")
    rows = stored(
        benchmark.select(
            F.col(item_column).cast("long").alias("item_id"), F.col(item_text_column).alias("text"),
            answer.alias("answer"),
        ),
        "items",
    )
    n_blocks = max(1, math.ceil(rows.count() / ITEMS_AT_ONCE))
    out = spark.createDataFrame([], _FOUND)
    for block in range(n_blocks):
        some = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        items = load_items([tuple(r) for r in some.orderBy("item_id", "text").collect()])
        if not items.ids:
            continue
        weights = inverse_frequencies(texts, items.vocabulary)
        sparse = [(items.columns(i).tolist(), weights[items.columns(i)].tolist()) for i in range(len(items.ids))]
        passages = spark.createDataFrame(sparse, "columns array<int>, values array<double>")
        space = latent_space(passages, len(items.vocabulary), max(RANK, len(items.ids)))
        index = spark.sparkContext.broadcast(build_index(items, weights, space))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            held = index.value
            for whole in batches:
                for at in range(0, whole.num_rows, _DOCS_AT_ONCE):
                    part = whole.slice(at, _DOCS_AT_ONCE)
                    keys = part.column(0).to_pylist()
                    rows = [
                        (keys[text], held.items.ids[item], *numbers)
                        for text, item, *numbers in search_texts(part.column(1).to_pylist(), held)
                    ]
                    if rows:
                        kinds = [pa.int64()] * 3 + [pa.float64()] * 4
                        names = ["doc_id", "item_id", "first_word", "cosine", "coverage", "lcs", "answer"]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                        )

        out = out.unionByName(texts.mapInArrow(released(search), _FOUND))
    return out
