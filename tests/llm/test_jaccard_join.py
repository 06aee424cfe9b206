from __future__ import annotations

import random
from itertools import combinations

import pytest
from made_up import plain_words, prose, words

from windrow.llm import jaccard_join
from windrow.llm.components import connected_components


def brute(rows):
    sets = []
    for _, text in rows:
        w = plain_words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    parent = {key: key for key, _ in rows if key is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(list(zip([k for k, _ in rows], sets, strict=True)), 2):
        if None not in (a, b) and x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return sorted(
        ((k, len(s), find(k) if k is not None else None) for (k, _), s in zip(rows, sets, strict=True)), key=str
    )


def near_copies(n: int, edits: int, size: int = 80):
    base, rows = words(5, size), []
    for key in range(n):
        some = random.Random(key)
        text = list(base)
        for _ in range(some.randint(0, edits)):
            text[some.randrange(size)] = "".join(some.choices("xyz", k=5))
        rows.append((key, " ".join(text)))
    return rows


def found(docs):
    return sorted((tuple(r) for r in jaccard_join.join_documents(docs).collect()), key=str)


def test_odd_documents(odd_docs, odd_rows):
    assert found(odd_docs) == brute(odd_rows)


def test_no_documents(no_docs):
    assert jaccard_join.join_documents(no_docs).count() == 0


@pytest.mark.parametrize("region_rows", [5, 1500])
def test_near_copies_in_small_and_large_regions(make_docs, monkeypatch, region_rows):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", region_rows)
    rows = near_copies(70, 5) + [(1000 + k, prose(k)) for k in range(20)]
    rows += [(2000 + k, prose(99, 200) + " " + prose(k + 50, 30)) for k in range(20)]
    assert found(make_docs(rows)) == brute(rows)


def brute_counts(rows):
    sets = []
    for _, text in rows:
        w = plain_words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    counts = [0] * len(rows)
    for i, j in combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if None not in (rows[i][0], rows[j][0]) and x and y and 100 * len(x & y) >= 75 * len(x | y):
            counts[i] += 1
            counts[j] += 1
    return sorted(((k, n) for (k, _), n in zip(rows, counts, strict=True)), key=str)


@pytest.mark.parametrize("region_rows", [5, 1500])
def test_links_of_every_document(make_docs, monkeypatch, region_rows):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", region_rows)
    rows = near_copies(50, 5) + [(1000 + k, prose(k)) for k in range(10)]
    rows += [(2000 + k, prose(99, 200) + " " + prose(k + 50, 30)) for k in range(15)]
    rows += [(3, prose(1)), (3, prose(1)), (None, prose(1)), (4, None)]
    counts = jaccard_join.join_documents(make_docs(rows), count_links=True).select("doc_id", "n_links")
    assert sorted((tuple(r) for r in counts.collect()), key=str) == brute_counts(rows)


@pytest.mark.parametrize("region_rows", [5, 1500])
def test_every_link_is_listed_once(spark, monkeypatch, region_rows):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", region_rows)
    some = random.Random(0)
    sets = {k: sorted({*range(40)} - {*some.sample(range(40), some.randint(1, 6))} | {100 + k}) for k in range(40)}
    frame = spark.createDataFrame(list(sets.items()), "node bigint, hashes array<bigint>")
    links = sorted(tuple(r) for r in jaccard_join.similar_links(frame, every=True).collect())
    wanted = [
        (a, b) for a, b in combinations(sets, 2)
        if 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]})
    ]
    assert links == wanted and len(wanted) > len(sets)


def test_a_link_at_exactly_three_quarters(make_docs):
    base = words(8, 104)
    rows = [(1, " ".join(base)), (2, " ".join(base[:79])), (3, " ".join(base[:78]))]
    result = {r[0]: r for r in found(make_docs(rows))}
    assert result[2][2] == 1 and found(make_docs(rows)) == brute(rows)
    assert found(make_docs([rows[0], rows[2]])) == brute([rows[0], rows[2]])


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    links = spark.createDataFrame(chain + star + [(7, 7)], "a bigint, b bigint")
    result = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert result == {i: 1 for i in range(1, 41)} | {100 + i: 100 for i in range(50)}
    assert connected_components(links.limit(0)).count() == 0
