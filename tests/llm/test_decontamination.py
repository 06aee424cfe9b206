from __future__ import annotations

import random

import numpy as np
from made_up import prose, words

from windrow.llm import decontamination as d

ITEMS = [(k, f"{prose(k + 500, 30)}. {prose(k + 900, 8)}.") for k in range(12)]


def test_verbatim_paraphrased_and_clean(spark, make_docs):
    item = ITEMS[4][1].split(" ")
    paraphrase = [w if i % 5 else "other" for i, w in enumerate(item)]
    rows = [
        (1, f"{prose(1)} {ITEMS[2][1]} {prose(2)}"), (2, prose(3, 400)),
        (3, f"{prose(4, 333)}\n{' '.join(paraphrase)} {prose(5)}"), (4, None), (5, ""),
        (6, ITEMS[0][1].upper() + "!!"), (7, " ".join(item[:10])), (8, ITEMS[2][1] + " " + ITEMS[3][1]),
        (8, ITEMS[2][1] + " " + ITEMS[3][1]), (None, ITEMS[1][1]),
    ]
    benchmark = spark.createDataFrame(
        [*ITEMS, (50, None), (51, ""), (52, " . "), (None, prose(1))], "item_id bigint, text string"
    )
    found = d.find_leaks(make_docs(rows, extra=True), benchmark.selectExpr("*", "1 AS doc_id", "2 AS answer"))
    pairs = sorted(((r["doc_id"], r["item_id"]) for r in found.collect()), key=str)
    assert pairs == sorted([(1, 2), (3, 4), (6, 0), (8, 2), (8, 3), (8, 2), (8, 3), (None, 1)], key=str)


def test_empty_tables(spark, make_docs, no_docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert d.find_leaks(no_docs, benchmark).count() == 0
    assert d.find_leaks(make_docs([(1, prose(1))]), benchmark.limit(0)).count() == 0


def test_blocks_of_items_find_the_same(spark, make_docs, monkeypatch):
    docs = make_docs([(k, f"{prose(k)} {text} {prose(k + 50)}") for k, text in ITEMS])
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    monkeypatch.setattr(d, "ITEMS_AT_ONCE", 4)
    assert {tuple(r) for r in d.find_leaks(docs, benchmark).select("doc_id", "item_id").collect()} == {
        (k, k) for k, _ in ITEMS
    }


def test_more_items_than_the_latent_space_has_directions(spark, make_docs):
    # No two items share a word, and the short ones are the weakest directions.
    n = d.RANK + 40
    items = [(k, " ".join(f"item{k}word{i}" for i in range(4 if k >= 40 else 1))) for k in range(n)]
    docs = make_docs([(k, f"{prose(k, 20)} {text} {prose(k + 5000, 20)}") for k, text in items])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = d.find_leaks(docs, benchmark).select("doc_id", "item_id", "coverage", "lcs").collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(k, k) for k, _ in items]
    assert all(r["lcs"] == 1 and abs(r["coverage"] - 1) < 1e-9 for r in found)


def test_words_of_other_items_around_an_item_do_not_hide_it(spark, make_docs):
    items = [(1, "alone"), (2, prose(2, 11) + " no such words"), (3, prose(3, 11) + " nor these ones")]
    around = f"{prose(2, 11)} alone {prose(3, 11)}"
    docs = make_docs([(1, around), *[(10 + k, f"alone {prose(k + 50)}") for k in range(5)]])
    found = d.find_leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {r["doc_id"] for r in found if r["item_id"] == 1} == {1, *range(10, 15)}


def test_paraphrases_that_change_the_rare_words(spark, make_docs):
    common, rare = words(1, 24), [f"name{i}" for i in range(16)]
    item = [rare.pop() if i % 5 in (1, 3) else common[i // 5 * 3 + (0, 0, 1, 1, 2)[i % 5]] for i in range(40)]
    changed = [w if not w.startswith("name") else "gap" for w in item]
    fewer = [w if i else "gap" for i, w in enumerate(changed)]
    # The common words stand in all documents, the rare ones in none.
    corpus = [(100 + k, "\n".join([prose(k + 50, 30), *common[::-1]])) for k in range(60)]
    rows = [(1, " ".join(changed) + " forty two exactly"), (2, " ".join(fewer) + " forty two exactly"), *corpus]
    benchmark = spark.createDataFrame(
        [(1, " ".join(item), "forty two exactly")], "item_id bigint, text string, gold string"
    )
    found = d.find_leaks(make_docs(rows), benchmark, answer_column="gold").collect()
    assert [(r["doc_id"], r["lcs"]) for r in found] == [(1, 0.6)]


def test_an_answer_decides_on_paraphrases(spark, make_docs):
    item = words(1, 40)
    kept = [w if i % 10 not in (1, 4, 7) else "gap" for i, w in enumerate(item)]
    # A word's weight needs a corpus around it.
    corpus = [(100 + k, prose(k + 100)) for k in range(100)]
    docs = make_docs([(1, " ".join(kept)), (2, " ".join(kept) + " forty two exactly"), *corpus])
    benchmark = spark.createDataFrame(
        [(1, " ".join(item), "forty two exactly")], "item_id bigint, text string, gold string"
    )
    found = d.find_leaks(docs, benchmark, answer_column="gold").collect()
    assert [r["doc_id"] for r in found] == [2]


def test_latent_space_spans_the_matrix(spark):
    some = np.random.default_rng(0)
    matrix = some.standard_normal((30, 5)) @ some.standard_normal((5, 40))
    rows = [(list(range(40)), row.tolist()) for row in matrix]
    space = d.latent_space(spark.createDataFrame(rows, "columns array<int>, values array<double>"), 40, rank=8)
    assert space.shape == (40, 5)
    assert np.allclose(space.T @ space, np.eye(5), atol=1e-8)
    assert np.allclose(matrix @ space @ space.T, matrix, atol=1e-6)


def test_candidates_come_from_the_latent_space(spark, make_docs, monkeypatch):
    docs = make_docs([(k, f"{prose(k)} {text} {prose(k + 50)}") for k, text in ITEMS])
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert d.find_leaks(docs, benchmark).count() == len(ITEMS)
    whole = d.latent_space

    def without_last(*given):
        return whole(*given) * (np.arange(len(ITEMS)) < len(ITEMS) - 1)

    monkeypatch.setattr(d, "latent_space", lambda *given: np.zeros_like(whole(*given)))
    assert d.find_leaks(docs, benchmark).count() == 0
    # A space that lacks a direction finds some, but not what lies mostly along it.
    monkeypatch.setattr(d, "latent_space", without_last)
    assert 0 < d.find_leaks(docs, benchmark).count() < len(ITEMS)


def test_latent_search_loses_no_match_of_all_pairs():
    some = random.Random(5)
    known = [f"w{i}" for i in range(120)]
    sizes = [some.choice([1, 2, 5, 12, 18, 30, 40, 70]) for _ in range(60)]
    texts = [" ".join(some.choices(known, weights=range(1, 121), k=k)) for k in sizes]
    items = d.load_items([(i, text, None) for i, text in enumerate(texts)])
    docs = [None, ""]
    for text in texts:
        parts = text.split()
        for share in (0.1, 0.25, 0.35, 0.5):
            changed = [some.choice(["gap", *known]) if some.random() < share else w for w in parts]
            around = [" ".join(some.choices([*known, "gap", "hole"], k=some.randrange(90))) for _ in range(2)]
            docs.append(f"{around[0]} {' '.join(changed)} {around[1]}")
    docs = [text or "" for text in docs]
    weights = np.array([np.log1p(len(docs) / (1 + k)) for k in range(len(items.vocabulary))])
    matrix = np.zeros((len(texts), len(weights)))
    for i in range(len(texts)):
        matrix[i, items.columns(i)] = weights[items.columns(i)]
    _, values, space = np.linalg.svd(matrix, full_matrices=False)
    found = d.search_texts(docs, d.build_index(items, weights, space[values > 1e-6].T))

    expected = {}
    for at, text in enumerate(docs):
        passage = d._words([text])[0]
        for i, (wanted, answer) in enumerate(zip(items.words, items.answers, strict=True)):
            half = max(16, 1 << (len(wanted) - 1).bit_length()) // 2
            for start in range(0, len(passage), half):
                part = passage[start : start + 3 * half]
                lcs = d.common_subsequence(wanted, part) / len(wanted)
                told = d.common_subsequence(answer, part) / len(answer)
                if lcs >= d.VERBATIM_SHARE or (lcs >= d.PARAPHRASE_SHARE and told >= d.ANSWER_SHARE):
                    expected[at, i] = max(lcs, expected.get((at, i), 0))
    assert {(at, i): lcs for at, i, _, _, _, lcs, _ in found} == expected
    assert len(expected) > 200 and min(expected.values()) < 0.7


def test_passages_are_folded_alike_in_any_chunks(monkeypatch):
    items = d.load_items([(k, text, None) for k, text in [*ITEMS, (12, "alone"), (13, prose(7, 100))]])
    texts = ["", *(f"{prose(k, 41 * k)} {text} {prose(k + 50, 90)}" for k, text in ITEMS), "alone", prose(7, 130)]
    weights = np.ones(len(items.vocabulary))
    index = d.build_index(items, weights, np.eye(len(weights)))
    once = d.search_texts(texts, index)
    assert {row[1] for row in once} == set(range(14))
    for words_at_once in (1, 50, 200):
        monkeypatch.setattr(d, "_WORDS_AT_ONCE", words_at_once)
        assert d.search_texts(texts, index) == once


def test_least_product_bounds_every_choice_of_missing_words():
    some = np.random.default_rng(2)
    for _ in range(40):
        squares, times = some.random(6) * 9, some.integers(1, 4, 6)
        for missing in range(int(times.sum()) + 1):
            gone = [np.array([(k >> i) & 1 for i in range(6)], bool) for k in range(64)]
            least = min(squares[~g].sum() for g in gone if times[g].sum() <= missing)
            assert d._least_product(squares, times, missing) <= least + 1e-9


def test_common_subsequence_against_a_table():
    some = np.random.default_rng(1)
    for _ in range(50):
        a, b = (some.integers(0, 4, some.integers(0, 12)).astype(np.uint64) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert d.common_subsequence(a, b) == table[-1, -1]
