"""Exact Jaccard similarity join of word-shingle sets in their metric space.

Distance 1 - Jaccard is a metric, so a pivot p proves |d(r, p) - d(s, p)| <= d(r, s). The join
1. leaves out documents that share too few shingles with the corpus to have any partner;
2. draws pivots among the rest: of the documents that hold a rare shingle, the one of least
   hash is that shingle's pivot, and a document belongs to the regions of its shingles' pivots
   (partners share such a shingle, so they meet in a region);
3. measures every document's distance to its pivots; those within the radius are linked to
   the pivot, and so to one another;
4. joins each region: only pairs within the radius of each other's pivot distance can link,
   and of these, pairs that are connected already need no look. A large region draws further
   pivots among its members and is cut into Voronoi cells; members that do not hang together
   with most of the region visit every cell whose pivot is at most two radii further away than
   their own, and cells are joined in turn, block by block, each by a pivot of its own.

Step 4 finds components. Where all links are asked for (``every``, ``count_links``), no pair is
left out because it is connected already: every window is verified whole, every member of a large
region visits, and a pair that meets in several regions is taken in the first of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import release_memory, released, stored
from windrow.llm.components import connected_components
from windrow.llm.shingles import mix, shingle_sets

WORDS, PERCENT = 5, 75
#: Shingles whose hash is below this share of all hashes are counted over the corpus.
COUNTED_SHARE = 0.5
#: Counted shingles that one batch of documents sends on together, and its documents at most.
BATCH_SHINGLES, BATCH_DOCS = 400_000, 60_000
#: Counted shingles that one bucket should have, and bytes of text that hold one of them or so.
BUCKET_SHINGLES, BYTES_PER_SHINGLE = 2_000_000, 12
_DOCS_AT_ONCE = 256
#: Bits of the filter that lets through the documents which may have partners. Its size is
#: fixed; once it is full it only lets more through.
FILTER_BITS = 1 << 23
#: Members of a region (or of a side of a cell) that one task joins.
REGION_ROWS = 1500
_INFO = -1
_PACKED = "batch bigint, bucket int, payload binary"
_DOCS = "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, may_link boolean"
_SETS = "doc_id bigint, key_a bigint, key_b bigint, hashes array<bigint>"
_LINKS = "a bigint, b bigint"
_COUNTS = "node bigint, n bigint"


def fewest_shared(n: int | np.ndarray) -> int | np.ndarray:
    """The least intersection that a set of n needs to link: ceil(0.75 n)."""
    return -(-PERCENT * n // 100)


def _keys(found: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    if len(found) == 0:
        return 0, 0
    order = np.arange(1, 2 * len(found), 2, dtype=np.uint64)
    a = (found * order).sum(dtype=np.uint64)
    b = ((found ^ (found >> np.uint64(29))) * (order + np.uint64(0x9E3779B97F4A7C14))).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))


def _batch(batch: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([batch] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.binary()),
        ],
        names=["batch", "bucket", "payload"],
    )


def _count_shingles(texts: DataFrame, n_buckets: int) -> DataFrame:
    """doc_id, set size, set key and whether the document may have a partner, for every row.

    Counts in how many documents a shingle stands, for the counted share of all hashes. Batches
    of documents send sorted packed hashes to buckets of the hash range; a bucket returns how
    many shingles of each document stand elsewhere as well. A document links only if at most a
    quarter of its shingles stand nowhere else. (Hashes are cut to five bytes here; chance
    collisions only let more documents through.)
    """
    limit = int(COUNTED_SHARE * 2**64) - 1
    width = limit // n_buckets + 1

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        sets: list[np.ndarray] = []
        infos: list[tuple[int, int, int, int]] = []
        counted = 0

        def flush() -> pa.RecordBatch:
            hashes = np.concatenate(sets)
            docs = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
            order = np.argsort(hashes)
            hashes, docs = hashes[order], docs[order]
            bucket = (hashes // np.uint64(width)).astype(np.int64)
            cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
            rest = hashes - bucket.astype(np.uint64) * np.uint64(width)
            # Five high bytes of the place within the bucket.
            rest >>= np.uint64(max(0, int(width).bit_length() - 40))
            low, high = (rest & np.uint64(0xFFFFFFFF)).astype("<u4"), (rest >> np.uint64(32)).astype("u1")
            rows = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                x, y = cuts[b], cuts[b + 1]
                rows.append((b, low[x:y].tobytes() + high[x:y].tobytes() + docs[x:y].astype("<u2").tobytes()))
            known = np.array([i is not None for i in ids], dtype="u1")
            info = np.array(infos, dtype="<i8").reshape(len(ids), 4)
            keys = np.array([i or 0 for i in ids], dtype="<i8")
            rows.append((_INFO, keys.tobytes() + info.tobytes() + known.tobytes()))
            return _batch(seq, rows)

        for whole in batches:
            for at in range(0, whole.num_rows, _DOCS_AT_ONCE):
                part = whole.slice(at, _DOCS_AT_ONCE)
                keys = part.column(0).to_pylist()
                for key, found in zip(keys, shingle_sets(part.column(1).to_pylist(), WORDS), strict=True):
                    some = found[: np.searchsorted(found, np.uint64(limit))]
                    ids.append(key)
                    sets.append(some)
                    infos.append((len(found), len(some), *_keys(found)))
                    counted += len(some)
                if counted >= BATCH_SHINGLES or len(ids) >= BATCH_DOCS:
                    yield flush()
                    seq, counted = seq + 1, 0
                    ids, sets, infos = [], [], []
        if ids:
            yield flush()

    def shared(key: tuple, group: pa.Table) -> pa.Table:
        """For each batch, (document, shingles that stand in another document too)."""
        if key[0].as_py() < 0:
            return group.select(["batch", "bucket", "payload"])
        batch, payloads = group.column("batch").to_pylist(), group.column("payload").to_pylist()
        sizes = np.array([len(p) // 7 for p in payloads])
        hashes = np.empty(sizes.sum(), dtype=np.uint64)
        docs = np.empty(sizes.sum(), dtype=np.uint16)
        at = 0
        for data, n in zip(payloads, sizes.tolist(), strict=True):
            low = np.frombuffer(data, "<u4", n)
            high = np.frombuffer(data, "u1", n, 4 * n)
            hashes[at : at + n] = low + (high.astype(np.uint64) << np.uint64(32))
            docs[at : at + n] = np.frombuffer(data, "<u2", n, 5 * n)
            at += n
        order = np.argsort(hashes)
        ordered = hashes[order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(hashes), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        out, at = [], 0
        for name, n in zip(batch, sizes.tolist(), strict=True):
            found, counts = np.unique(docs[at : at + n][twice[at : at + n]], return_counts=True)
            at += n
            if len(found):
                out.append((name, found.astype("<u2").tobytes() + counts.astype("<u4").tobytes()))
        bucket = key[0].as_py()
        del hashes, docs, order, ordered, same, twice, payloads
        release_memory()
        return pa.table(
            {
                "batch": pa.array([n for n, _ in out], pa.int64()),
                "bucket": pa.array([bucket] * len(out), pa.int32()),
                "payload": pa.array([p for _, p in out], pa.binary()),
            }
        )

    def judged(group: pa.Table) -> pa.Table:
        info = next(
            p for b, p in zip(group.column("bucket").to_pylist(), group.column("payload").to_pylist(), strict=True)
            if b == _INFO
        )
        n = len(info) // 41
        ids = np.frombuffer(info, "<i8", n)
        numbers = np.frombuffer(info, "<i8", 4 * n, 8 * n).reshape(n, 4)
        known = np.frombuffer(info, "u1", n, 40 * n).astype(bool)
        total = np.zeros(n, dtype=np.int64)
        for b, p in zip(group.column("bucket").to_pylist(), group.column("payload").to_pylist(), strict=True):
            if b != _INFO:
                m = len(p) // 6
                total[np.frombuffer(p, "<u2", m)] += np.frombuffer(p, "<u4", m, 2 * m)
        size, counted = numbers[:, 0], numbers[:, 1]
        may = (counted - total <= size - fewest_shared(size)) & (size > 0) & known
        return pa.table(
            {
                "doc_id": pa.array(ids, mask=~known), "n_shingles": pa.array(size),
                "key_a": pa.array(numbers[:, 2]), "key_b": pa.array(numbers[:, 3]),
                "may_link": pa.array(may),
            }
        )

    rows = texts.mapInArrow(released(packed), _PACKED)
    # The rows with the documents' own numbers pass through, each batch's in a group of its own.
    spread = F.when(F.col("bucket") == _INFO, -1 - F.pmod(F.xxhash64("batch"), F.lit(n_buckets))).otherwise(
        F.col("bucket")
    )
    counted = rows.withColumn("spread", spread).groupBy("spread").applyInArrow(shared, _PACKED)
    return counted.groupBy("batch").applyInArrow(judged, _DOCS)


def _may_link_filter(docs: DataFrame) -> np.ndarray:
    """Bits at the hashes of the document ids that may link, as bytes; a fixed number of them."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = docs.where("may_link").select((at / 64).cast("int").alias("word"), (at % 64).cast("int").alias("bit"))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
    found = words.groupBy("word").agg(bits.alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    table[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return table


def _candidate_sets(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, set key and hashes of the documents that may link, one for each distinct set."""
    spark = texts.sparkSession
    bits = spark.sparkContext.broadcast(_may_link_filter(docs))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _DOCS_AT_ONCE):
                part = whole.slice(at, _DOCS_AT_ONCE)
                place = part.column(2).to_numpy()
                hit = (bits.value[place // 64] >> (place % 64)) & 1 == 1
                part = part.filter(pa.array(hit & ~part.column(0).is_null().to_numpy(zero_copy_only=False)))
                if part.num_rows == 0:
                    continue
                found = shingle_sets(part.column(1).to_pylist(), WORDS)
                keys = [_keys(f) for f in found]
                offsets = np.append(0, np.cumsum([len(f) for f in found]))
                hashes = np.concatenate(found).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes)),
                    ],
                    names=["doc_id", "key_a", "key_b", "hashes"],
                )

    placed = texts.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)))
    found = placed.mapInArrow(released(sets), _SETS)
    # Only the smallest document of each set stands for it.
    first = docs.where("may_link").groupBy("key_a", "key_b").agg(F.min("doc_id").alias("doc_id"))
    return found.join(first, ["doc_id", "key_a", "key_b"], "left_semi").dropDuplicates(["key_a", "key_b"])


def _rare_postings(sets: DataFrame) -> DataFrame:
    """node, size and hash for the shingles by which partners must meet.

    Ordered from rare to frequent, two linked sets share one of the first
    n - ceil(0.75 n) + 1 shingles of each. Shingles of one set alone are counted, not returned.
    """
    posted = sets.select("node", F.size("hashes").alias("size"), F.explode("hashes").alias("hash"))
    often = posted.groupBy("hash").agg(F.count("*").alias("often")).where("often > 1")
    kept = posted.join(often, "hash")
    ordered = kept.groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("often", "hash"))).alias("found")
    )
    prefix = F.col("size") - F.ceil(F.col("size") * PERCENT / 100).cast("int") + 1
    alone = F.col("size") - F.size("found")
    rare = F.slice("found", 1, F.greatest(prefix - alone, F.lit(0)))
    return ordered.select("node", F.explode(rare["hash"]).alias("hash"))


class _Region:
    """The sets of a region as bit rows over the shingles that two of them share."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        new = np.append(True, every[1:] != every[:-1])
        number = np.cumsum(new) - 1
        shared = np.bincount(number)[number] > 1
        columns = np.cumsum(new & shared) - 1
        self.columns, self.owners = columns[shared], owner[shared]
        n_columns = int(self.columns[-1]) + 1 if len(self.columns) else 0
        self.bits = np.zeros((len(sets), -(-n_columns // 64)), dtype=np.uint64)
        np.bitwise_or.at(
            self.bits, (self.owners, self.columns >> 6),
            np.uint64(1) << (self.columns & 63).astype(np.uint64),
        )

    def shared(self, row: int, others: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.bits[others] & self.bits[row]).sum(axis=1, dtype=np.int64)

    def linked(self, row: int, others: np.ndarray) -> np.ndarray:
        both = self.shared(row, others)
        union = self.sizes[row] + self.sizes[others] - both
        return 100 * both >= PERCENT * union

    def distance(self, row: int, others: np.ndarray) -> np.ndarray:
        both = self.shared(row, others)
        return 1 - both / (self.sizes[row] + self.sizes[others] - both)


#: Distances are compared with this much room, as they are rounded; links are decided in integers.
_ROOM = 1e-9
_RADIUS = 1 - PERCENT / 100


_NO_GROUP = np.iinfo(np.int64).min


class _Union:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def join_region(
    nodes: np.ndarray, sets: list[np.ndarray], home: np.ndarray, groups: np.ndarray,
    among_home: bool = True,
) -> list[tuple[int, int]]:
    """Links that connect what the region's pairs with a home member connect.

    The member of least hash is the pivot; the others are joined by windows of their distance
    to it. Two members of one component need no look: the result connects the same nodes as
    all links would. Members of the same group (_NO_GROUP: none) are known to be connected. Pairs
    of two home members are left out unless ``among_home``.
    """
    region, union = _Region(sets), _Union(len(nodes))
    everyone = np.arange(len(nodes))
    links: list[tuple[int, int]] = []
    for names, named in ((nodes, everyone), (groups, everyone[groups != _NO_GROUP])):
        _, first, same = np.unique(names[named], return_index=True, return_inverse=True)
        for row, leader in zip(named.tolist(), named[first[same]].tolist(), strict=True):
            union.join(row, leader)

    def link(row: int, others: np.ndarray) -> None:
        for other in others.tolist():
            if union.join(row, other):
                links.append((int(nodes[row]), int(nodes[other])))

    pivot = int(np.argmin(mix(nodes.view(np.uint64))))
    away = region.distance(pivot, everyone)
    near = region.linked(pivot, everyone)
    near[pivot] = False
    if home[pivot]:
        link(pivot, everyone[near])
    else:
        link(pivot, everyone[near & home])
    by_distance = np.argsort(away, kind="stable")
    sorted_away = away[by_distance]
    for row in everyone[home].tolist():
        lo = np.searchsorted(sorted_away, away[row] - _RADIUS - _ROOM)
        hi = np.searchsorted(sorted_away, away[row] + _RADIUS + _ROOM, side="right")
        others = by_distance[lo:hi]
        sizes = region.sizes[others]
        fits = (100 * np.minimum(sizes, region.sizes[row]) >= PERCENT * np.maximum(sizes, region.sizes[row]))
        fits &= ((others > row) & among_home) | ~home[others]
        others = others[fits]
        roots = union.roots()
        others = others[roots[others] != roots[row]]
        if len(others):
            link(row, others[region.linked(row, others)])
    return links


def _links_table(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table(
        {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
    )


def _columns(group: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    lists = pa.concat_arrays(group.column("hashes").chunks)
    values = lists.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(lists.value_lengths().to_numpy())
    return group.column("node").to_numpy().astype(np.int64), np.split(values, ends[:-1])


def _join_group(group: pa.Table) -> pa.Table:
    """Links of a whole region."""
    if group.num_rows < 2:
        return _links_table([])
    nodes, sets = _columns(group)
    alone = np.full(len(nodes), _NO_GROUP)
    return _links_table(join_region(nodes, sets, np.ones(len(nodes), dtype=bool), alone))


def _join_visitors(group: pa.Table) -> pa.Table:
    """Links between a cell's visitors and its residents."""
    visits = group.column("visits").to_numpy()
    if not visits.any() or visits.all():
        return _links_table([])
    nodes, sets = _columns(group)
    known = pa.concat_arrays(group.column("component").chunks).fill_null(_NO_GROUP).to_numpy()
    return _links_table(join_region(nodes, sets, visits, known, among_home=False))


def every_pair(
    nodes: np.ndarray, sets: list[np.ndarray], regions: list[np.ndarray], here: int,
    visits: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all linked pairs of the region ``here``, the smaller node first.

    ``regions`` has the regions of each member; a pair that shares an earlier one is left to it.
    With ``visits`` pairs are of a visitor and a resident.
    """
    region = _Region(sets)
    earlier = _Region([r[r <= here] for r in regions])
    away = region.distance(int(np.argmin(mix(nodes.view(np.uint64)))), np.arange(len(nodes)))
    by_distance = np.argsort(away, kind="stable")
    sorted_away = away[by_distance]
    rows, partners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in range(len(nodes)) if visits is None else np.flatnonzero(visits).tolist():
        lo = np.searchsorted(sorted_away, away[row] - _RADIUS - _ROOM)
        hi = np.searchsorted(sorted_away, away[row] + _RADIUS + _ROOM, side="right")
        others = by_distance[lo:hi]
        sizes = region.sizes[others]
        fits = (100 * np.minimum(sizes, region.sizes[row]) >= PERCENT * np.maximum(sizes, region.sizes[row]))
        fits &= nodes[others] > nodes[row]
        if visits is not None:
            fits &= ~visits[others]
        others = others[fits]
        others = others[region.linked(row, others)]
        # All share this region; one more is an earlier one.
        others = others[earlier.shared(row, others) == 1]
        rows.append(np.full(len(others), row))
        partners.append(others)
    return np.concatenate(rows), np.concatenate(partners)


def _join_every(cells: bool, counted: bool) -> Callable[[pa.Table], pa.Table]:
    """Joins a whole region (or a cell's blocks) to all its links, or to how many copies each
    member's links lead to."""

    def joined(group: pa.Table) -> pa.Table:
        nodes, sets = _columns(group)
        lists = pa.concat_arrays(group.column("regions").chunks)
        ends = np.cumsum(lists.value_lengths().to_numpy())
        regions = np.split(lists.flatten().to_numpy(), ends[:-1])
        visits = group.column("visits").to_numpy() if cells else None
        i, j = every_pair(nodes, sets, regions, group.column("region")[0].as_py(), visits)
        if not counted:
            return pa.table({"a": pa.array(nodes[i]), "b": pa.array(nodes[j])})
        copies, total = group.column("copies").to_numpy(), np.zeros(len(nodes), dtype=np.int64)
        np.add.at(total, i, copies[j])
        np.add.at(total, j, copies[i])
        some = total > 0
        return pa.table({"node": pa.array(nodes[some]), "n": pa.array(total[some])})

    return joined


_CELLS = "region bigint, cell bigint, node bigint, home boolean, tied boolean"


def _measure(group: pa.Table) -> pa.Table:
    """Distances of a block of members to all pivots of their region.

    One row for each cell (pivot) that a member lives in (``home``: the nearest pivot), may find
    partners in (a pivot at most two radii further away), or is linked to (``tied``).
    """
    nodes, sets = _columns(group)
    is_pivot = group.column("is_pivot").to_numpy()
    pivots, members = np.flatnonzero(is_pivot), np.flatnonzero(~is_pivot)
    found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),) * 2]
    if len(pivots) and len(members):
        region = _Region(sets)
        away = np.stack([region.distance(p, members) for p in pivots.tolist()])
        linked = np.stack([region.linked(p, members) for p in pivots.tolist()])
        nearest = away.argmin(axis=0)
        cell, member = np.nonzero(away <= away.min(axis=0) + 2 * _RADIUS + _ROOM)
        found.append(
            (nodes[pivots[cell]], nodes[members[member]], nearest[member] == cell, linked[cell, member])
        )
    cells, inside, home, tied = (np.concatenate(x) for x in zip(*found, strict=True))
    region_name = group.column("region")[0].as_py()
    return pa.table(
        {
            "region": pa.array([region_name] * len(cells), pa.int64()), "cell": pa.array(cells),
            "node": pa.array(inside), "home": pa.array(home), "tied": pa.array(tied),
        }
    )


def _blocks(n: Column) -> Column:
    return F.ceil(n / REGION_ROWS).cast("int")


def _block(salt: str, n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), n_blocks).cast("int")


def _measured(members: DataFrame, drawn: DataFrame, sets: DataFrame) -> DataFrame:
    """All members (region, node, n) of large regions measured against the pivots (region, node)."""
    n_blocks = _blocks(F.col("n"))
    asked = members.select("region", "node", F.lit(False).alias("is_pivot"), _block("block", n_blocks).alias("block"))
    sizes = members.select("region", "n").distinct()
    pivots = drawn.join(sizes, "region").select(
        "region", "node", F.lit(True).alias("is_pivot"),
        F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"),
    )
    rows = asked.unionByName(pivots).join(sets, "node")
    return stored(rows.groupBy("region", "block").applyInArrow(_measure, _CELLS), "jaccard-cells")


def _ties(cells: DataFrame) -> DataFrame:
    return cells.where("tied and node <> cell").select(F.col("node").alias("a"), F.col("cell").alias("b"))


def _draw(rows: DataFrame, salt: str) -> DataFrame:
    """About 2 n / REGION_ROWS + 16 of a region's n rows, by their hash."""
    share = F.pmod(F.xxhash64("region", "node", F.lit(salt)), F.col("n"))
    return rows.where(share < 2 * F.col("n") / REGION_ROWS + 16).select("region", "node")


def _meetings(visitors: DataFrame, residents: DataFrame, more: list[str]) -> DataFrame:
    """Blocks v of each cell's visitors with blocks r of its residents: one row for each member
    and meeting, with the columns ``more``."""
    visits = visitors.groupBy("region", "cell").agg(F.count("*").alias("n_visits"))
    stays = residents.groupBy("region", "cell").agg(F.count("*").alias("n_stays"))
    sizes = stored(visits.join(stays, ["region", "cell"]), "jaccard-sizes")
    v_blocks, r_blocks = _blocks(F.col("n_visits")), _blocks(F.col("n_stays"))
    first, last = F.lit(0), F.lit(1)
    coming = visitors.join(sizes, ["region", "cell"]).select(
        "region", "cell", "node", *more, F.lit(True).alias("visits"),
        _block("visitor", v_blocks).alias("v"), F.explode(F.sequence(first, r_blocks - last)).alias("r"),
    )
    living = residents.join(sizes, ["region", "cell"]).select(
        "region", "cell", "node", *more, F.lit(False).alias("visits"),
        F.explode(F.sequence(first, v_blocks - last)).alias("v"), _block("resident", r_blocks).alias("r"),
    )
    return coming.unionByName(living.select(coming.columns))


def _large_regions(members: DataFrame, sets: DataFrame) -> list[DataFrame]:
    """Links of regions (region, node, n) with more members than one task should join.

    Pivots are drawn in two rounds, among all members and among those that no pivot is linked
    to; each is measured against the whole region. The first round's Voronoi cells are then
    joined: every member resides in the cell of its nearest pivot. What hangs together already
    needs no look, so only members outside the region's largest component visit, and of the
    cells only those whose pivot is at most two radii further from them than their own. Blocks
    of visitors meet blocks of residents.
    """
    own = members.where("node = region").select("region", "node")
    cells = _measured(members, _draw(members, "first").unionByName(own).distinct(), sets)
    free = members.join(_ties(cells), F.col("node") == F.col("a"), "left_anti")
    left = free.groupBy("region").agg(F.count("*").alias("n"))
    second = _measured(members, _draw(free.drop("n").join(left, "region"), "second"), sets)
    ties = stored(_ties(cells).unionByName(_ties(second)), "jaccard-ties")
    known = stored(connected_components(ties), "jaccard-known")
    named = members.select("region", "node").join(known, "node", "left")
    counts = named.where("component is not null").groupBy("region", "component").count()
    largest = counts.groupBy("region").agg(F.max_by("component", "count").alias("largest"))
    named = stored(named.join(largest, "region", "left"), "jaccard-named")
    outside = ~F.coalesce(F.col("component") == F.col("largest"), F.lit(False))
    visitors = cells.join(named.where(outside).select("region", "node", "component"), ["region", "node"])
    residents = cells.where("home").join(named.select("region", "node", "component"), ["region", "node"])
    rows = _meetings(visitors, residents, ["component"]).join(sets, "node")
    links = rows.groupBy("region", "cell", "v", "r").applyInArrow(_join_visitors, _LINKS)
    return [ties, stored(links, "jaccard-links")]


def _regions(sets: DataFrame) -> DataFrame:
    """region, node, and the region's number of members n, for regions of two at least."""
    postings = stored(_rare_postings(sets), "jaccard-postings")
    first = F.min(F.struct(F.xxhash64("node").alias("priority"), F.col("node").alias("pivot")))
    pivots = postings.groupBy("hash").agg(first.alias("first"), F.count("*").alias("n"))
    pivots = pivots.where("n > 1").select("hash", F.col("first.pivot").alias("region"))
    members = stored(postings.join(pivots, "hash").select("region", "node").distinct(), "jaccard-regions")
    sizes = members.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
    return stored(members.join(sizes, "region"), "jaccard-members")


def _every_link(sets: DataFrame, counted: bool) -> DataFrame:
    """All links once, or (node, n) with the copies that links lead to, in several rows a node.

    In a large region each member resides in the cell of its nearest pivot and visits all cells
    whose pivot is at most two radii further away, so each link's ends meet in either's cell; it
    is taken in that of the larger end.
    """
    members = _regions(sets)
    kind = _COUNTS if counted else _LINKS
    sets = sets.join(members.groupBy("node").agg(F.collect_list("region").alias("regions")), "node")
    small = members.where(F.col("n") <= REGION_ROWS).join(sets, "node")
    found = stored(small.groupBy("region").applyInArrow(_join_every(False, counted), kind), "jaccard-links")
    large = members.where(F.col("n") > REGION_ROWS)
    if large.isEmpty():
        return found
    own = large.where("node = region").select("region", "node")
    hashes = sets.select("node", "hashes")
    cells = _measured(large, _draw(large, "first").unionByName(own).distinct(), hashes)
    rows = _meetings(cells, cells.where("home"), []).join(sets, "node")
    more = rows.groupBy("region", "cell", "v", "r").applyInArrow(_join_every(True, counted), kind)
    return found.unionByName(stored(more, "jaccard-links"))


def similar_links(sets: DataFrame, every: bool = False) -> DataFrame:
    """Links (a, b) that connect the same nodes as all pairs of at least 75 % similarity; with
    ``every`` all these pairs, each once with a < b.

    ``sets`` has node and hashes (sorted distinct 64-bit shingle hashes), distinct sets only;
    ``every`` wants a node of its own for each set. A group of n near copies has up to
    n (n - 1) / 2 links; ``link_counts`` counts them without listing.
    """
    if every:
        return _every_link(sets, counted=False)
    members = _regions(sets)
    small = members.where(F.col("n") <= REGION_ROWS).join(sets, "node")
    found = stored(small.groupBy("region").applyInArrow(_join_group, _LINKS), "jaccard-links")
    large = members.where(F.col("n") > REGION_ROWS)
    if not large.isEmpty():
        for more in _large_regions(large, sets):
            found = found.unionByName(more)
    return found


def link_counts(sets: DataFrame) -> DataFrame:
    """node and n_links: how many copies the sets linked to the node's have together. Nodes
    without links are left out. ``sets`` is that of ``similar_links`` with copies, for each set."""
    return _every_link(sets, counted=True).groupBy("node").agg(F.sum("n").alias("n_links"))


def join_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", count_links: bool = False
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, and n_links with ``count_links``: how
    many other rows (with an id) hold a text that links to the row's.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z read as a-z; a set has the distinct five-word
    shingles of the whole text, or one shingle of all words if there are fewer. Sets link when
    their intersection is at least 75 % of their union; component_id is the smallest doc_id
    that links reach. Texts that are null or without words have no shingles and link with
    nothing. Rows without an id link with nothing and have a null component; rows that share an
    id are one document with several texts. Other columns are not read. No rows give no rows.
    Shingles are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = _texts(docs, id_column, text_column)
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(
        4 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes // (BYTES_PER_SHINGLE * BUCKET_SHINGLES) + 1
    )
    found = stored(_count_shingles(texts, n_buckets), "jaccard-documents")
    # A document with several texts has several sets.
    set_id = F.xxhash64("key_a", "key_b").alias("set_id")
    sets = stored(_candidate_sets(texts, found).select(F.col("doc_id").alias("node"), set_id, "hashes"), "jaccard-sets")
    links = similar_links(sets.select("node", "hashes"))
    components = stored(connected_components(links), "jaccard-components")
    may_link = found.where("may_link")
    classes = (
        may_link.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
        .join(components, "node", "left")
        .select("key_a", "key_b", "copies", F.coalesce("component", "node").alias("class_component"))
    )
    columns = ["doc_id", "n_shingles", F.col("class_component").alias("component_id")]
    if count_links:
        copies = classes.select(set_id.alias("node"), "copies")
        counts = stored(
            link_counts(sets.select(F.col("set_id").alias("node"), "hashes").join(copies, "node")), "jaccard-counts"
        )
        counts = counts.select(F.col("node").alias("set_id"), "n_links")
        classes = classes.withColumn("set_id", set_id).join(counts, "set_id", "left").withColumn(
            "n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1
        )
        columns.append("n_links")
    linked = may_link.join(classes, ["key_a", "key_b"], "left").select(*columns)
    alone = found.where(~F.col("may_link")).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    if count_links:
        alone = alone.withColumn("n_links", F.lit(0).cast("long"))
    return linked.unionByName(alone)
