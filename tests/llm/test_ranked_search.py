"""Ranked search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from made_up import prose
from pyspark.sql import functions as F

from windrow.llm import ranked_search
from windrow.llm.ranked_search import Shard, impacts, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranks(docs, items, k=10):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    every = sum(c.total() for _, c in counts)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, held in counts:
            score = 0
            for term in set(plain_terms(text)) & set(held):
                df = sum(term in c for _, c in counts)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                m = 100 - 90 + (90 * held.total() * n_docs) // every
                score += w * (1000000000 * held[term] // (1000 * held[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        best = sorted(scored, key=lambda s: s[:3])[:k]
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(best)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=str)


def test_terms_equal_the_pattern():
    made = random.Random(3)
    for _ in range(500):
        text = "".join(chr(made.choice([made.randrange(128), made.randrange(128, 0x3000), 0x1F600])) for _ in range(30))
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)
    assert terms_of(None) == terms_of("") == terms_of("\x00 -`{\x7f") == []


@pytest.mark.parametrize("seed", range(12))
def test_a_shard_finds_what_scoring_finds(seed):
    made = np.random.default_rng(seed)
    n_docs, n_terms, k = int(made.integers(1, 3000)), int(made.integers(1, 40)), int(made.integers(1, 20))
    dense = made.integers(0, 4, (n_terms, n_docs)) * (made.random((n_terms, n_docs)) < made.random((n_terms, 1)))
    terms, docs = np.nonzero(dense)
    impact = 1000 // (1 + made.integers(0, 3, n_docs))[docs] * dense[terms, docs]
    weights = made.integers(0, 50, n_terms)
    scores = np.zeros(n_docs, dtype=np.int64)
    np.add.at(scores, docs, weights[terms] * impact)
    shard = Shard(terms, docs, impact, n_docs)
    for floor in (1, int(np.sort(scores)[-min(k, n_docs)]) + 1):
        least = max(floor, int(np.sort(scores)[-k]) if k <= n_docs else 1)
        at, exact, read = shard.search(np.arange(n_terms), weights, k, floor)
        assert np.array_equal(at, np.flatnonzero(scores >= least)) and np.array_equal(exact, scores[at])
        assert read <= len(terms)


def test_search_stops_before_the_lists_end():
    n = 100_000
    impact = np.concatenate([np.full(20, 900_000), np.arange(n - 20, 0, -1)])
    shard = Shard(np.zeros(n, np.int64), np.arange(n), impact, n)
    at, scores, read = shard.search(np.array([0]), np.array([7]), 10, 1)
    assert len(at) == 20 and (scores == 7 * 900_000).all() and read < 1000


def test_impacts_of_huge_corpora_do_not_overflow():
    found = impacts(np.array([3, 1]), np.array([10**9, 5]), 10**11, 10**13)
    expected = [10**9 * t // (1000 * t + 8 * (10 + 90 * n * 10**11 // 10**13)) for t, n in ((3, 10**9), (1, 5))]
    assert found.tolist() == expected


def documents():
    made = random.Random(11)
    vocabulary = ["".join(made.choices("abcdé", k=made.randint(1, 3))) for _ in range(60)]
    docs = [(i, " ".join(made.choices(vocabulary, k=made.randint(0, 40)))) for i in range(300)]
    docs += [(1000 + i, docs[5][1].upper().replace("É", "é")) for i in range(25)]
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, None), (2000, None), (2001, ""), (2002, "-- \x00 {}")]
    items = [(i, " ".join(made.choices([*vocabulary, "nowhere"], k=made.randint(1, 12)))) for i in range(30)]
    items += [(100, docs[5][1]), (101, docs[7][1] + " " + docs[7][1]), (102, None), (103, ""), (104, "nowhere"), (None, "a b")]
    return docs, items


def test_ranks_equal_plain_scoring(spark):
    docs, items = documents()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("n_terms", "terms", "item", "rank", "score", "item_id")})
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    expected = plain_ranks(docs, items)
    assert found(ranked_search.rank_documents(df, asked)) == expected
    small = ranked_search.rank_documents(df, asked, terms_at_once=20, shard_postings=40)
    assert found(small) == expected


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs, odd_rows):
    items = [(1, prose(3)), (2, prose(1, 30_000)), (3, "日本 one TWO")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(ranked_search.rank_documents(odd_docs, asked, k=5)) == plain_ranks([r[:2] for r in odd_rows], items, 5)
    assert found(ranked_search.rank_documents(no_docs, asked)) == []
    assert found(ranked_search.rank_documents(odd_docs, asked.limit(0))) == []
