from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from made_up import prose

from windrow.llm import suffix_family
from windrow.llm.anchors import HEAD, LENGTH, Fingerprints, find_anchors


def brute(rows):
    seen: dict[bytes, tuple] = {}
    out = []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - LENGTH + 1):
            window = data[i : i + LENGTH]
            if seen.setdefault(window, (key, i)) != (key, i):
                gone[i : i + LENGTH] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((key, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(docs, cuts=(0.5,)):
    rows = suffix_family.remove_repeats(docs, cuts=cuts).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))


def planted():
    shared, some = prose(1, 40), random.Random(3)
    rows = [(k, f"{prose(k + 10, some.randint(0, 30))} {shared} {prose(k + 90, 25)}") for k in range(12)]
    rows += [(20, "ab" * 300), (21, "x" * 99), (22, "x" * 100), (23, "x" * 101), (24, "é" * 120)]
    rows += [(30 + k, shared[k * 7 :] + "Ü" + shared[: 200 - k]) for k in range(6)]
    return rows + [(50, rows[0][1]), (51, rows[0][1])]


@pytest.mark.parametrize("cuts", [(), (0.25,), (0.2, 0.4, 0.6, 0.8)])
def test_against_brute_force(make_docs, cuts):
    rows = planted()
    assert found(make_docs(rows), cuts) == brute(rows)


def test_odd_documents(odd_docs, odd_rows):
    # Rows that share an id count as one text laid on another, so each keeps its own bytes.
    once = [r for r in {id(r): r for r in odd_rows}.values() if [x[0] for x in odd_rows].count(r[0]) == 1]
    result = found(odd_docs)
    assert len(result) == len(odd_rows)
    wanted = {r[0]: r for r in brute(odd_rows)}
    for row in result:
        if row[0] in {k for k, _ in once}:
            assert row == wanted[row[0]]


def test_kept_text(make_docs):
    text = prose(4, 50)
    docs = make_docs([(1, text), (2, f"new {text}"), (3, None)])
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_family.remove_repeats(docs, with_text=True).collect()}
    assert kept == {1: text.encode(), 2: b"new ", 3: b""}


def test_no_documents(no_docs):
    assert suffix_family.remove_repeats(no_docs).count() == 0


def test_levels_merge_geometrically(make_docs):
    family, sizes = suffix_family.SuffixFamily(), []
    for batch in range(5):
        docs = make_docs([(10 * batch + k, prose(batch * 10 + k)) for k in range(3)])
        family.add(suffix_family._documents(docs, "doc_id", "text"))
        sizes.append(list(family.sizes))
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    seen = family.add(suffix_family._documents(make_docs([(90, prose(11))]), "doc_id", "text"), keep=False)
    assert seen.where("kind = 'repeat'").count() > 0


def test_equal_windows_have_equal_anchors():
    some = random.Random(1)
    block = bytes(some.choices(b"abcd ", k=400))
    texts = [bytes(some.choices(b"xyz", k=k)) + block + b"end" for k in (0, 13, 77)]
    anchors = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        _, first, windows, head, _ = find_anchors(Fingerprints(data), np.array([len(data)]))
        owner = {}
        for start, count, name in zip(first.tolist(), windows.tolist(), head.tolist(), strict=True):
            owner |= {start + k: name for k in range(count)}
        shift = text.index(block)
        anchors.append([owner[shift + i] for i in range(len(block) - LENGTH + 1)])
    assert anchors[0] == anchors[1] == anchors[2] and HEAD < LENGTH
