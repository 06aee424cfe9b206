"""Random forests grown level by level from sums over binned rows, as models of MLlib.

Each feature is cut into bins once, and rows are written as chunks of their bins (a byte for each
feature) and targets. A level of all trees is one pass over the chunks: a task finds the open node
of each row in each tree from the cuts so far and adds up weights and targets by node and bin. The
sums of a tree meet in one group, which picks the best cut of each node; cuts alone come to the
driver. Features with few bins are added up together, by pairs or triples of bins, and taken apart
at the end of the task, which gives the same sums with fewer passes over the rows.

As in MLlib every tree sees each row as often as a Poisson number of mean 1 says, and a node whose
two leaves predict the same is a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from math import ceil, exp, factorial, prod, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.session import COMPRESSION, scratch_path

#: Bins of a feature at most: they are bytes.
MAX_BINS = 256
#: Rows of a chunk, chunks that a task takes at once, and chunks of a Parquet row group.
CHUNK_ROWS, CHUNKS_AT_ONCE, CHUNKS_A_GROUP = 8_192, 8, 64
#: Values of a column that a task sorts at once, and how many with their counts it keeps.
SORTED_AT_ONCE, SUMMARY = 1 << 18, 1 << 12
#: Combinations of bins that features are added up by together.
JOINT_BINS = 4_096
#: Combinations of node and bins that a task has sums of at a time (128 MB).
CELLS_AT_ONCE = 1 << 23
#: Gains below this share of the square of the target's mean are rounding.
LEAST_GAIN = 1e-12
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def cuts(df: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """The values at which a tree may cut each column, ascending, less than ``bins`` of them: between
    any two values, or, of a column with more, at the values that share out the rows evenly.

    One pass: a task keeps the values of a column with their counts, and of more than SUMMARY values
    those that share out its rows.
    """
    if not columns:
        return []
    at_once, kept, n_columns = SORTED_AT_ONCE, SUMMARY, len(columns)

    def fold(parts: list[tuple[np.ndarray, np.ndarray]], at_most: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Values in order, each once, with the rows up to it that no earlier one counts."""
        values, counts = (np.concatenate(some) for some in zip(*parts, strict=True))
        order = np.argsort(values, kind="stable")
        values, first = np.unique(values[order], return_index=True)
        counts = np.add.reduceat(counts[order], first) if len(values) else counts
        if at_most and len(values) > at_most:
            upto = np.cumsum(counts)
            picks = np.unique(np.searchsorted(upto, np.arange(1, at_most + 1) * upto[-1] / at_most))
            values, counts = values[picks], np.diff(upto[picks], prepend=0)
        return values, counts

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (np.zeros(0), np.zeros(0, np.int64))
        held, waiting, known = [[] for _ in range(n_columns)], 0, [nothing] * n_columns

        def take() -> None:
            for i, some in enumerate(held):
                known[i] = fold([known[i], np.unique(np.concatenate(some), return_counts=True)], kept)
                some.clear()

        for batch in batches:
            for some, c in zip(held, batch.columns, strict=True):
                some.append(c.to_numpy(zero_copy_only=False))
            waiting += batch.num_rows
            if waiting >= at_once:
                take()
                waiting = 0
        if waiting:
            take()
        for i, (values, counts) in enumerate(known):
            yield pa.RecordBatch.from_pydict({
                "at": pa.array([i], pa.int32()), "vals": pa.array([values.tobytes()], pa.binary()),
                "counts": pa.array([counts.astype(np.int64).tobytes()], pa.binary()),
            })

    def choose(found: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(v.as_buffer()), np.frombuffer(n.as_buffer(), np.int64)) for v, n in zip(found["vals"], found["counts"], strict=True)]
        values, counts = fold(parts, None)
        if len(values) <= bins:
            chosen = (values[:-1] + values[1:]) / 2
        else:
            upto = np.cumsum(counts)
            places = np.unique(np.searchsorted(upto, np.arange(1, bins) * upto[-1] / bins))
            chosen = values[places[places < len(values) - 1]]
        return pa.table({"at": found["at"][:1].combine_chunks(), "vals": pa.array([chosen.tobytes()], pa.binary())})

    given = df.select(*[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(columns)])
    partial = given.mapInArrow(summarise, "at int, vals binary, counts binary")
    # A row for each column, of a cut for each bin.
    rows = partial.groupBy("at").applyInArrow(choose, "at int, vals binary").collect()
    listed = {r["at"]: np.frombuffer(r["vals"]) for r in rows}
    return [listed.get(i, np.zeros(0)) for i in range(n_columns)]


def together(sizes: Sequence[int], at_most: int = JOINT_BINS) -> list[list[int]]:
    """Features with so many bins, in groups whose combinations of bins are ``at_most`` where a
    group has more than one."""
    groups: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [g for g in groups if prod(sizes[j] for j in g) * sizes[i] <= at_most]
        if fits:
            max(fits, key=lambda g: prod(sizes[j] for j in g)).append(i)
        else:
            groups.append([i])
    return groups


def _chunks(df: DataFrame, columns: Sequence[str], target: str, thresholds: Sequence[np.ndarray]) -> DataFrame:
    """Writes chunks of rows: ``chunk`` (its number), ``codes`` (bytes, feature by feature) and
    ``targets`` (doubles)."""
    rows_at_once, context = CHUNK_ROWS, TaskContext

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, waiting = context.get().partitionId(), 0, [], 0

        def flush(at_most: int) -> Iterator[pa.RecordBatch]:
            nonlocal number, held, waiting
            whole, targets = (np.concatenate(parts, axis=-1) for parts in zip(*held, strict=True))
            at = 0
            while at < waiting and waiting - at >= at_most:
                end = min(at + rows_at_once, waiting)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([(part << 33) + number], pa.int64()),
                    "codes": pa.array([np.ascontiguousarray(whole[:, at:end]).tobytes()], pa.binary()),
                    "targets": pa.array([targets[at:end].tobytes()], pa.binary()),
                })
                number, at = number + 1, end
            held, waiting = [(whole[:, at:], targets[at:])], waiting - at

        for batch in batches:
            if any(c.null_count for c in batch.columns):
                raise ValueError("rows to fit must have no nulls")
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if any(np.isnan(v).any() for v in values):
                raise ValueError("rows to fit must have no NaN")
            codes = [np.searchsorted(t, v).astype(np.uint8) for t, v in zip(thresholds, values, strict=False)]
            held.append((np.stack(codes), values[-1]))
            waiting += batch.num_rows
            if waiting >= rows_at_once:
                yield from flush(rows_at_once)
        if waiting:
            yield from flush(1)

    spark = df.sparkSession
    given = df.select(*[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate([*columns, target])])
    made = given.mapInArrow(encode, "chunk bigint, codes binary, targets binary")
    path = scratch_path(spark, "binned")
    writer = made.write.option("compression", COMPRESSION).option("parquet.enable.dictionary", "false")
    # Chunks are large for rows: few of them are held to be written, or read, at a time.
    writer.option("parquet.block.row.count.limit", str(CHUNKS_A_GROUP)).parquet(path)
    return spark.read.schema(made.schema).parquet(path)


@contextmanager
def _few_chunks(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(CHUNKS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


def _poisson() -> list[int]:
    """A row counts as often as there are numbers here at or below its own, one of 16 bits."""
    upto = np.cumsum([exp(-1) / factorial(k) for k in range(12)])
    return [n for n in np.round(upto * (1 << 16)).astype(int).tolist() if n < 1 << 16]


def _level(
    chunks: DataFrame, sizes: Sequence[int], trees: Sequence[dict], open_nodes: Sequence[Sequence[int]],
    classes: bool, cut: bool, subset: int, seed: int,
) -> dict[int, np.ndarray]:
    """Of each tree that has open nodes, a row for each: weight, and sum of the target; with ``cut``
    feature, bin and gain of the best cut (a feature of -1 for none), else its sum of squares.

    Nodes are numbered from 1, the children of ``n`` are ``2n`` and ``2n + 1``; a tree has the cuts
    (feature, bin) of its nodes so far.
    """
    groups = together(sizes) if cut else []
    n_features, starts, width = len(sizes), np.concatenate([[0], np.cumsum(sizes)]), sum(sizes)
    often, count, least = _poisson(), len(trees), LEAST_GAIN
    # Both sums of a class fit one number: weights below, those of class 1 above.
    unit, rows_to_flush = float(1 << 26), (1 << 26) // len(often) - CHUNK_ROWS * CHUNKS_AT_ONCE

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [len(nodes) + 1 for nodes in open_nodes]  # the last for rows that are done
        joint = [prod(sizes[f] for f in g) for g in groups]
        # For each tree and group: weights and sums or, of classes, both in one.
        sums = [[np.zeros((1 if classes else 2, n * p)) for n in joint] if nodes else [] for p, nodes in zip(places, open_nodes, strict=True)]
        totals = [np.zeros((3, p)) for p in places]
        whole: list[list[np.ndarray]] = []
        since = 0

        def both(t: int, i: int) -> np.ndarray:
            if not classes:
                return sums[t][i]
            late = np.floor(sums[t][i][0] / unit)
            found = np.stack([sums[t][i][0] - late * unit, late])
            return found + whole[t][i] if whole else found

        for batch in batches:
            numbers, blobs, answers = (c.to_pylist() for c in batch.columns)
            y = np.concatenate([np.frombuffer(a) for a in answers])
            codes = np.concatenate([np.frombuffer(b, np.uint8).reshape(n_features, -1) for b in blobs], axis=1)
            lengths = [len(a) // 8 for a in answers]
            drawn = np.concatenate([
                np.random.SFC64([seed, n]).random_raw(-(-count * size // 4)).view(np.uint16)[: count * size].reshape(count, size)
                for n, size in zip(numbers, lengths, strict=True)
            ], axis=1)
            bases = []
            for g in groups:
                base = codes[g[0]].astype(np.int64)
                for f in g[1:]:
                    base = base * sizes[f] + codes[f]
                bases.append(base)
            squares, many = None if groups else y * y, 0
            for t, nodes in enumerate(open_nodes):
                if not nodes:
                    continue
                tree, p, kind = trees[t], places[t], np.uint8 if len(nodes) < 256 else np.uint32
                place, done = {node: kind(i) for i, node in enumerate(nodes)}, kind(len(nodes))

                def walk(node: int):
                    if node not in tree:
                        return place.get(node, done)
                    feature, last = tree[node]
                    left, right = walk(2 * node), walk(2 * node + 1)
                    # All bits are set where a row goes right; much faster than np.where.
                    return left ^ ((left ^ right) & -(codes[feature] > last).astype(kind))

                at = np.broadcast_to(walk(1), y.shape).astype(np.int64)
                counts = np.zeros(len(y), np.uint8)
                for number in often:
                    counts += (drawn[t] >= number).view(np.uint8)
                w = counts.astype(float)
                wy = w * y
                if not groups:
                    for total, values in zip(totals[t], (w, wy, w * squares), strict=True):
                        total += np.bincount(at, values, p)
                    continue
                if p != many:
                    scaled, many = [base * p for base in bases], p
                added = [w + unit * wy] if classes else [w, wy]
                for i, base in enumerate(scaled):
                    cell = base + at
                    for total, values in zip(sums[t][i], added, strict=True):
                        total += np.bincount(cell, values, joint[i] * p)
            since += len(y)
            if classes and since >= rows_to_flush:
                whole = [[both(t, i) for i in range(len(some))] for t, some in enumerate(sums)]
                for some in sums:
                    for one in some:
                        one[:] = 0
                since = 0
        for t, nodes in enumerate(open_nodes):
            if not nodes:
                continue
            found = np.zeros((2, width if cut else 0, len(nodes)))
            for i, g in enumerate(groups):
                shaped = both(t, i).reshape(2, *[sizes[f] for f in g], places[t])[..., :-1]
                for axis, f in enumerate(g, 1):
                    others = tuple(a for a in range(1, len(g) + 1) if a != axis)
                    found[:, starts[f] : starts[f + 1]] = shaped.sum(axis=others)
            blob = (found if groups else totals[t][:, :-1]).tobytes()
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "sums": pa.array([blob], pa.binary())})

    def best(found: pa.Table) -> pa.Table:
        t = found["tree"][0].as_py()
        nodes = open_nodes[t]
        found = sum(np.frombuffer(b.as_buffer()) for b in found["sums"])
        if not cut:
            picked = found.reshape(3, -1).T
            return pa.table({"tree": pa.array([t], pa.int32()), "picked": pa.array([picked.tobytes()], pa.binary())})
        found, picked = found.reshape(2, -1, len(nodes)), np.zeros((len(nodes), 5))
        for i, node in enumerate(nodes):
            w, wy = found[:, : starts[1], i].sum(axis=1)
            picked[i] = w, wy, -1, 0, 0
            if not w:
                continue
            features = range(n_features)
            if subset < n_features:
                features = sorted(np.random.default_rng([seed, t, node]).choice(n_features, subset, replace=False))
            for f in features:
                left, late = np.cumsum(found[:, starts[f] : starts[f + 1] - 1, i], axis=1)
                right = w - left
                fits = (left > 0) & (right > 0)
                if not fits.any():
                    continue
                gains = np.full(len(left), -1.0)
                left, late, right = left[fits], late[fits], right[fits]
                gains[fits] = (late**2 / left + (wy - late) ** 2 / right - wy**2 / w) / w
                if gains.max() > max(picked[i, 4], least * (wy / w) ** 2):
                    picked[i, 2:] = f, gains.argmax(), gains.max()
        if classes:
            picked[:, 4] *= 2  # Gini's impurity is twice the variance of 0 and 1.
        return pa.table({"tree": pa.array([t], pa.int32()), "picked": pa.array([picked.tobytes()], pa.binary())})

    with _few_chunks(chunks.sparkSession):
        partial = chunks.mapInArrow(add_up, "tree int, sums binary")
        rows = partial.groupBy("tree").applyInArrow(best, "tree int, picked binary").collect()  # a row for each tree
    return {r["tree"]: np.frombuffer(r["picked"]).reshape(-1, 5 if cut else 3) for r in rows}


def binned(
    df: DataFrame, columns: Sequence[str], target: str, thresholds: Sequence[np.ndarray]
) -> DataFrame:
    """The rows as chunks, each of ``columns`` cut at its thresholds, less than MAX_BINS."""
    if max(map(len, thresholds), default=0) >= MAX_BINS:
        raise ValueError(f"a feature has at most {MAX_BINS} bins")
    chunks = _chunks(df, columns, target, thresholds)
    if not chunks.select("chunk").head(1):
        raise ValueError("there are no rows to fit")
    return chunks


def portions(nodes: Sequence[Sequence[int]], cells: int, at_most: int = CELLS_AT_ONCE) -> Iterator[list[list[int]]]:
    """The open nodes of all trees, as many in a pass as a task can hold the sums of, with ``cells``
    for each node and for each tree's rows that are done."""
    portion, used = [[] for _ in nodes], 0
    for t, some in enumerate(nodes):
        for node in some:
            if used and used + cells * (1 if portion[t] else 2) > at_most:
                yield portion
                portion, used = [[] for _ in nodes], 0
            used += cells * (1 if portion[t] else 2)
            portion[t].append(node)
    if used:
        yield portion


def grow(
    chunks: DataFrame, thresholds: Sequence[np.ndarray], estimator: Estimator, classes: bool,
    trees: int, depth: int, seed: int, some_features: bool = False,
) -> Model:
    """Grows ``trees`` trees over ``binned`` rows, and makes them a model of ``estimator``, a forest of
    MLlib. With ``some_features`` a node's cut comes from as many features, drawn at random, as the square
    root of their number."""
    sizes = [len(t) + 1 for t in thresholds]
    subset = ceil(sqrt(len(sizes))) if some_features else len(sizes)
    made: list[dict[int, tuple]] = [{} for _ in range(trees)]
    gains: list[dict[int, float]] = [{} for _ in range(trees)]
    cells = sum(prod(sizes[f] for f in g) for g in together(sizes))
    nodes: list[list[int]] = [[1] for _ in range(trees)]
    for _ in range(depth):
        further: list[list[int]] = [[] for _ in range(trees)]
        for portion in portions(nodes, cells):
            found = _level(chunks, sizes, made, portion, classes, True, subset, seed)
            for t, picked in found.items():
                split = [(node, row) for node, row in zip(portion[t], picked, strict=True) if row[2] >= 0]
                made[t].update((node, (int(row[2]), int(row[3]))) for node, row in split)
                gains[t].update((node, float(row[4])) for node, row in split)
                further[t] += [child for node, _ in split for child in (2 * node, 2 * node + 1)]
        nodes = further
        if not any(nodes):
            break
    # What a node holds is what its leaves hold.
    leaves = [[n for n in {1, *(c for node in tree for c in (2 * node, 2 * node + 1))} if n not in tree] for tree in made]
    found = _level(chunks, sizes, made, leaves, classes, False, subset, seed)
    totals = [dict(zip(leaves[t], found[t], strict=True)) for t in range(trees)]
    for tree, known in zip(made, totals, strict=True):
        for node in sorted(tree, reverse=True):
            known[node] = known[2 * node] + known[2 * node + 1]
    return _model(chunks.sparkSession, estimator, made, totals, gains, thresholds, classes)


def _model(
    spark: SparkSession, estimator: Estimator, trees: Sequence[dict], totals: Sequence[dict],
    gains: Sequence[dict], thresholds: Sequence[np.ndarray], classes: bool,
) -> Model:
    """The trees as MLlib's own nodes, so that it scores, stores and weighs features by them."""
    ml, impurity = spark._jvm.org.apache.spark.ml, spark._jvm.org.apache.spark.mllib.tree.impurity
    gateway, features = spark.sparkContext._gateway, len(thresholds)
    # Looked up once: each look-up asks the JVM.
    calculator_of = impurity.GiniCalculator if classes else impurity.VarianceCalculator
    leaf, internal, split_at, double = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, gateway.jvm.double

    def array(kind, values: Sequence):
        made = gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            made[i] = value
        return made

    def node(t: int, number: int):
        """The node, and what it predicts if it is a leaf."""
        w, wy, wyy = (float(v) for v in totals[t][number])
        share = wy / w if w else 0.0
        if classes:
            predicted, spread, counts = float(share > 0.5), 2 * share * (1 - share), [w - wy, wy]
        else:
            predicted, spread, counts = share, max(wyy / w - share**2, 0.0) if w else 0.0, [w, wy, wyy]
        calculator = calculator_of(array(double, counts), int(w))
        if number in trees[t]:
            (left, a), (right, b) = node(t, 2 * number), node(t, 2 * number + 1)
            if a is None or a != b:
                feature, last = trees[t][number]
                split = split_at(feature, float(thresholds[feature][last]))
                return internal(predicted, spread, gains[t][number], left, right, split, calculator), None
        return leaf(predicted, spread, calculator), predicted

    if classes:
        kind, forest, numbers = ml.classification.DecisionTreeClassificationModel, ml.classification.RandomForestClassificationModel, (features, 2)
    else:
        kind, forest, numbers = ml.regression.DecisionTreeRegressionModel, ml.regression.RandomForestRegressionModel, (features,)
    grown = [kind(f"{estimator.uid}_{t}", node(t, 1)[0], *numbers) for t in range(len(trees))]
    model = estimator._create_model(forest(estimator.uid, array(kind, grown), *numbers))
    model = estimator._copyValues(model)
    model._transfer_params_to_java()
    return model
