from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from windrow.llm import sharding


def test_laws_on_odd_documents(odd_docs, odd_rows, no_docs):
    rows = sharding.shard_documents(odd_docs, [1.0] * 8).collect()
    assert len(rows) == len(odd_rows)
    wanted = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == wanted
    shards, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        shards[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(no_docs, [1.0] * 8).count() == 0


def test_weights_and_moves(spark):
    keys = spark.range(20_000)
    before, after = [1.0, 2.0, 0.0, 1.0], [1.0, 2.0, 0.0, 2.0]
    rows = keys.select(
        sharding.rendezvous_shard(F.col("id"), before).alias("a"),
        sharding.rendezvous_shard(F.col("id"), after).alias("b"),
        sharding.rendezvous_shard(F.col("id"), before[:-1]).alias("c"),
    ).collect()
    counts = Counter(r["a"] for r in rows)
    assert counts[2] == 0 and abs(counts[1] - 10_000) < 400 and abs(counts[0] - 5_000) < 400
    # A shard that grows only takes, one that is removed only gives.
    assert all(r["a"] == r["b"] or r["b"] == 3 for r in rows)
    assert all(r["a"] == r["c"] or r["a"] == 3 for r in rows)


def test_a_hot_group_keeps_gapless_slots(spark):
    rows = spark.range(0, 5_000, 1, 7).select("id", (F.col("id") % 50 == 0).alias("rare"))
    numbered = sharding.number_rows(rows, "rare", "slot").collect()
    for rare in (True, False):
        assert sorted(r["slot"] for r in numbered if r["rare"] == rare) == list(range(sum(r["rare"] == rare for r in numbered)))


@pytest.mark.parametrize("weights", [[], [0.0], [1.0, -1.0]])
def test_bad_weights(weights):
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(None, weights)
