"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines beside it;
neighbouring labels influence each other through a transition table. The marginals of the
forward-backward pass, weighted by the lines' lengths, give the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import released

#: Bounds of the rows the model is fitted on (on the driver): documents, and lines of them.
MAX_TRAIN_DOCS, MAX_TRAIN_LINES = 3000, 150_000
#: Chains longer than this are cut for the fit; scoring uses whole documents.
TRAIN_CHAIN = 64
THRESHOLD = 0.3
_DOCS_AT_ONCE = 512
_CELLS_AT_ONCE = 1 << 20

_NEWLINE = 10
#: Classes of bytes whose share of a line is a feature.
_CLASSES = {
    "upper": [*range(65, 91)],
    "digit": [*range(48, 58)],
    "space": [9, 11, 12, 13, 32],
    "symbol": [ord(c) for c in '#$%&*+/<=>@[\\]^_`{|}~"()'],
    "pipe": [ord("|")],
    "exclamation": [ord("!")],
    "stop": [ord(c) for c in ".,;:?'-"],
    "not_ascii": [*range(128, 256)],
}
FEATURES = [
    "bias", "log_length", *_CLASSES, "word_length", "repeated_words", "repeated_line", "blank",
    "unended",
]


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, the lines' lengths in bytes plus one, and lines per text.

    An empty text has one empty line.
    """
    joined = "\n".join(texts).encode("utf-8", "surrogatepass") + b"\n"
    data = np.frombuffer(joined, dtype=np.uint8)
    ends = np.flatnonzero(data == _NEWLINE)
    starts = np.append(0, ends[:-1] + 1)
    length = ends - starts
    counts = np.array([t.count("\n") + 1 for t in texts])
    n = len(ends)
    safe = np.maximum(length, 1)
    columns = [np.ones(n), np.log1p(length) / 8]

    def shares(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64)

    for members in _CLASSES.values():
        lookup = np.zeros(256, dtype=np.uint8)
        lookup[members] = 1
        columns.append(shares(lookup[data]) / safe)
    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    blank = space[data]
    begins = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    words_before = np.searchsorted(begins, starts)
    words = np.append(words_before[1:], len(begins)) - words_before
    # Words and lines are compared by a sum of random numbers over their bytes.
    numbers = np.random.default_rng(0).integers(0, 1 << 40, 256)
    numbers[[9, 10, 11, 12, 13, 32]] = 0
    values = numbers[data]
    word_sums = np.add.reduceat(values, begins) if len(begins) else np.zeros(0, np.int64)
    same = np.append(False, word_sums[1:] == word_sums[:-1]) if len(begins) else np.zeros(0, bool)
    same[words_before[(words > 0)]] = False
    repeats = np.append(0, np.cumsum(same))
    repeated = repeats[words_before + words] - repeats[words_before]
    first = np.append(0, np.cumsum(counts)[:-1])
    line_sums = np.add.reduceat(values, starts)
    line_same = np.append(False, line_sums[1:] == line_sums[:-1]) & (length > 0)
    line_same[first] = False
    last_byte = data[np.maximum(ends - 1, 0)]
    ended = np.isin(last_byte, [ord(c) for c in ".!?:;"])
    columns += [
        (length / np.maximum(words, 1)) / 20, repeated / np.maximum(words, 1), line_same,
        length == 0, ~ended,
    ]
    return np.stack(columns, axis=1).astype(np.float64), length + 1, counts


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, then those of the line before and after it (zeros at the ends)."""
    ends = np.cumsum(counts)
    before = np.vstack([np.zeros((1, features.shape[1])), features[:-1]])
    after = np.vstack([features[1:], np.zeros((1, features.shape[1]))])
    before[ends - counts] = 0
    after[ends - 1] = 0
    return np.hstack([features, before, after])


@dataclass(frozen=True)
class LineModel:
    """``weights`` score label good against bad; ``moves[a, b]`` scores label b after a."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, inputs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of label good for every line, by forward-backward per document."""
        scores = np.clip(inputs @ self.weights, -30, 30)
        out = np.empty(len(scores))
        ends = np.cumsum(counts)
        size_class = np.ceil(np.log2(counts)).astype(int)
        for size in np.unique(size_class):
            group = np.flatnonzero(size_class == size)
            step = max(1, _CELLS_AT_ONCE >> int(size))
            for at in range(0, len(group), step):
                some = group[at : at + step]
                longest = counts[some].max()
                places = (ends - counts)[some][:, None] + np.arange(longest)
                inside = np.arange(longest) < counts[some][:, None]
                padded = np.where(inside, scores[np.where(inside, places, 0)], 0.0)
                good = _forward_backward(padded, inside, self.moves)[0]
                out[places[inside]] = good[inside]
        return out


def _forward_backward(
    scores: np.ndarray, inside: np.ndarray, moves: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of label good (chains, steps), expected moves (2, 2) and the log partition."""
    chains, steps = scores.shape
    node = np.stack([np.ones_like(scores), np.exp(scores)], axis=2)
    table = np.exp(moves)
    alpha = np.empty((chains, steps, 2))
    total = 0.0
    now = np.ones((chains, 2))
    for t in range(steps):
        there = inside[:, t]
        new = node[:, t] if t == 0 else (now @ table) * node[:, t]
        scale = new.sum(axis=1)
        total += np.log(scale[there]).sum()
        now = np.where(there[:, None], new / scale[:, None], now)
        alpha[:, t] = now
    good = np.empty((chains, steps))
    expected = np.zeros((2, 2))
    beta = np.ones((chains, 2))
    for t in range(steps - 1, -1, -1):
        there = inside[:, t]
        both = alpha[:, t] * beta
        both /= both.sum(axis=1, keepdims=True)
        good[:, t] = both[:, 1]
        if t:
            onward = node[:, t] * beta
            pair = alpha[:, t - 1, :, None] * table[None] * onward[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            expected += pair[there].sum(axis=0)
            back = onward @ table.T
            beta = np.where(there[:, None], back / back.sum(axis=1, keepdims=True), beta)
    return good, expected, total


def fit(
    inputs: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 200, l2: float = 1e-3
) -> LineModel:
    """Maximum likelihood by Adam on the whole sample; every line bears its document's label.

    Both classes weigh the same. Without rows of both labels all weights are zero, so every
    score is one half.
    """
    width = inputs.shape[1]
    theta = np.zeros(width + 4)
    if len(labels) == 0 or labels.min() == labels.max():
        return LineModel(theta[:width], theta[width:].reshape(2, 2))
    pieces = -(-counts // TRAIN_CHAIN)
    chain_labels = np.repeat(labels, pieces)
    lengths = np.concatenate(
        [[TRAIN_CHAIN] * (c // TRAIN_CHAIN) + ([c % TRAIN_CHAIN] if c % TRAIN_CHAIN else []) for c in counts]
    ).astype(int)
    starts = np.cumsum(lengths) - lengths
    steps = np.arange(lengths.max())
    inside = steps < lengths[:, None]
    places = np.where(inside, starts[:, None] + steps, 0)
    share = np.where(chain_labels == 1, (chain_labels == 1).mean(), (chain_labels == 0).mean())
    groups = [(y, np.flatnonzero(chain_labels == y)) for y in (0, 1)]
    weight = 0.5 / np.array([share[g].min() for _, g in groups]) / len(lengths)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        scores = np.clip(inputs @ theta[:width], -30, 30)
        gradient = l2 * theta
        for (label, group), w in zip(groups, weight, strict=True):
            in_group = inside[group]
            good, expected, _ = _forward_backward(
                np.where(in_group, scores[places[group]], 0.0), in_group,
                theta[width:].reshape(2, 2),
            )
            error = (good - label)[in_group]
            gradient[:width] += w * (error @ inputs[places[group][in_group]])
            seen = np.zeros((2, 2))
            seen[label, label] = (lengths[group] - 1).sum()
            gradient[width:] += w * (expected - seen).reshape(-1)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.05 * first / (1 - 0.9**step)
        theta = theta - rate / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return LineModel(theta[:width], theta[width:].reshape(2, 2))


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))


def in_held_out(id_column: str = "doc_id") -> Column:
    """Whether crc32 of the id's text leaves remainder 0 when divided by 5 (null id: false)."""
    digest = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(digest % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", max_docs: int = MAX_TRAIN_DOCS, max_lines: int = MAX_TRAIN_LINES,
) -> LineModel:
    """Fits the model on labelled rows that are not held out.

    At most ``max_docs`` documents, taken by a hash of the id, and of them, shortest first, as many
    as have ``max_lines`` lines together, so what the driver holds is bounded and a very long
    document costs no other its place. Null labels and labels other than 0 and 1 are left out; an
    id labelled twice counts by its smallest label, a repeated row once. An error if the bound on
    lines leaves one label of two.
    """
    marked = (
        labels.where(F.col(label_column).isin(0, 1) & ~in_held_out(id_column))
        .groupBy(F.col(id_column).alias("doc_id"))
        .agg(F.min(label_column).cast("int").alias("_label"))
    )
    by_hash = (F.xxhash64("doc_id", F.lit("train")), "doc_id")
    chosen = marked.orderBy(*by_hash).limit(max_docs)
    rows = _rows(docs, id_column, text_column)
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    joined = rows.join(chosen, "doc_id")
    # At most max_docs rows (more only where ids have several texts) reach this window.
    rows = joined.dropDuplicates(["doc_id", "text"]).withColumn("_lines", n_lines)
    so_far = F.sum("_lines").over(Window.orderBy("_lines", *by_hash, F.xxhash64("text")))
    rows = rows.withColumn("_so_far", so_far).where(F.col("_so_far") <= max_lines)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                found, _, counts = line_features([text])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label], pa.int32()), pa.array([int(counts[0])], pa.int64()),
                        pa.array([found.astype("<f4").tobytes()], pa.binary()),
                    ],
                    names=["label", "n_lines", "features"],
                )

    sample = (
        rows.select("text", "_label")
        .mapInArrow(features, "label int, n_lines bigint, features binary").collect()
    )
    counts = np.array([r["n_lines"] for r in sample], dtype=int)
    own = np.frombuffer(b"".join(bytes(r["features"]) for r in sample), dtype="<f4")
    own = own.reshape(-1, len(FEATURES)).astype(np.float64)
    inputs = with_neighbours(own, counts) if len(own) else np.zeros((0, 3 * len(FEATURES)))
    found = np.array([r["label"] for r in sample], dtype=int)
    if len(set(found.tolist())) < 2 and joined.select("_label").distinct().count() == 2:
        raise ValueError(f"{max_lines} lines do not hold documents of both labels")
    return fit(inputs, counts, found)


def score_documents(
    docs: DataFrame, model: LineModel, id_column: str = "doc_id", text_column: str = "text",
    keep: bool = False, score_column: str = "score",
) -> DataFrame:
    """Score of every whole text: the marginals of label good, weighted by line length plus one.

    A null text counts as empty: one blank line. One row per input row, null and repeated ids
    included; no rows give no rows. Returns doc_id and the score, or with ``keep`` all columns
    of ``docs`` and the score (its name must not be one of theirs).
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    kept = docs.columns if keep else [F.col(id_column).alias("doc_id")]
    if keep and score_column in docs.columns:
        raise ValueError(f"there is a column {score_column} already")
    # Names as given cannot clash with those of this function, as columns go by their place.
    rows = docs.select(*kept, text)
    names = [*docs.columns, score_column] if keep else ["doc_id", score_column]
    schema = docs.select(*kept).withColumn(score_column, F.lit(0.0)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _DOCS_AT_ONCE):
                batch = whole.slice(at, _DOCS_AT_ONCE)
                own, sizes, counts = line_features(batch.column(batch.num_columns - 1).to_pylist())
                good = model.marginals(with_neighbours(own, counts), counts)
                starts = np.cumsum(counts) - counts
                score = np.add.reduceat(good * sizes, starts) / np.add.reduceat(sizes, starts)
                columns = [*batch.columns[:-1], pa.array(np.clip(score, 0.0, 1.0))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(released(scored), schema)
