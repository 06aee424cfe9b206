from __future__ import annotations

import pytest
from made_up import plan_of, prose

from windrow.llm import licenses


def grams(text):
    w = (text or "").lower().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(rows, templates):
    out = {}
    for key, text in rows:
        found = grams(text)
        for name, template in templates:
            wanted = set(grams(template))
            stride, length = licenses.window_of(len(wanted))
            for start in range(0, max(1, len(found)), stride):
                share = len(wanted & set(found[start : start + length])) / len(wanted)
                if share >= 0.75 and (round(share, 6), -start) > out.get((key, name), (0, 0)):
                    out[key, name] = (round(share, 6), -start)
    return {k: (s, -p) for k, (s, p) in out.items()}


def test_against_brute_force(make_docs):
    long_template = dict(licenses.TEMPLATES)["BSD"].split()
    changed = [w if i not in (3, 20) else "Word" for i, w in enumerate(long_template)]
    rows = [(k, f"{prose(k, k * 9)} {text} {prose(k + 40, 7)}") for k, (_, text) in enumerate(licenses.TEMPLATES)]
    rows += [
        (50, prose(1) + " " + " ".join(changed)), (51, " ".join(long_template[:12])), (52, None), (53, ""),
        (54, "Released under the\nMIT  License."), (55, "RELEASED UNDER THE MIT LICENSE."), (56, "under the MIT License."),
        (57, "Released under the MIT License. " * 3), (57, "Released under the MIT License. "), (None, "Licensed under CC BY-NC 4.0."),
        (58, prose(9, 30_000) + " Licensed under CC BY-NC 4.0. " + prose(8)),
    ]
    result = licenses.scan_licenses(make_docs(rows, extra=True), licenses.TEMPLATES)
    assert "Python" not in plan_of(result)
    found = {(r["doc_id"], r["license"]): (r["containment"], r["first_word"]) for r in result.collect()}
    assert found == brute(rows, licenses.TEMPLATES)


def test_odd_documents(odd_docs, no_docs, spark):
    assert licenses.scan_licenses(odd_docs, licenses.TEMPLATES).count() == 0
    assert licenses.scan_licenses(no_docs, licenses.TEMPLATES).count() == 0
    with pytest.raises(ValueError):
        licenses.scan_licenses(odd_docs, [("short", "four words are few")])
