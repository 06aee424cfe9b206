"""Alignment of two tokenizers against a plain pass over all pairs of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from made_up import prose
from pyspark.sql import functions as F

from windrow.llm import alignment
from windrow.llm.common import let_workers_import
from windrow.llm.registry import llm_queries

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "Hello, world", " two  spaces ", "<|endoftext|> and </s>", "日本語 é \U0001f600 ok", "a▁b", "\x00\x01", "tab\tnew\nline\r\n",
    "nbsp   wide", "x" * 400, "don't DON'T 12345", "ﬁ ① Å", " ", "   ", "\n", "<0x41>", "<unk>",
]


@pytest.fixture(scope="module")
def coders():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B), ByteLevel()


def spans(tokens, data):
    if b"".join(t for _, t in tokens) != data:
        return None
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def plain(coders, docs):
    a, b, _ = coders
    marks = {m: bytes([v]) for m, v in alignment._byte_of_mark().items()}
    found = []
    for _, text in docs:
        data, one, two = b" " + (text or "").encode(), None, None
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            one = spans([(i, b"".join(marks[c] for c in a.id_to_token(i))) for i in ids], data)
            coded = [(i, b.id_to_piece(i)) for i in b.encode(text)]
            two = spans(
                [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in coded], data
            )
        if one is None or two is None:
            found.append(None)
            continue
        links = [(i, j) for i, s, e in one for j, t, f in two if s < f and t < e]
        both = sorted({e for *_, e in one} & {e for *_, e in two})
        groups, start = [], 0
        for end in both:
            left = ",".join(str(i) for i, s, e in one if s >= start and e <= end)
            right = ",".join(str(j) for j, s, e in two if s >= start and e <= end)
            groups.append(f"{left}|{right}")
            start = end
        found.append((len(one), len(two), groups, links))
    counts = Counter(p for f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = []
    for (doc_id, _), f in zip(docs, found, strict=True):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = f
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            n_best = sum(counts[p] == best[p[0]] for p in links)
            out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in df.collect()), key=str)


def test_marks_of_bytes(coders):
    marks = alignment._byte_of_mark()
    assert len(marks) == 256 and sorted(marks.values()) == list(range(256))
    assert coders[2].decode([m for m, v in marks.items() if v < 128]) == "".join(chr(v) for v in marks.values() if v < 128)


def test_alignment_equals_the_plain_pass(spark, make_docs, coders):
    let_workers_import(spark)
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    docs += [(100 + i, f"{prose(i, 12)} {t}") for i, t in enumerate(TEXTS)]
    docs += [(200, TEXTS[0]), (200, TEXTS[0]), (None, TEXTS[3]), (None, None), (201, None), (202, ""), (203, prose(1, 150))]
    expected = plain(coders, docs)
    assert any(r[1] == 0 for r in expected if r[0] == 4)
    df = make_docs(docs, extra=True).withColumns({c: F.lit("x") for c in ("pairs", "copies", "times", "text_key")})
    assert found(alignment.align_documents(df, A, B)) == expected
    assert found(alignment.align_documents(df, A, B, pairs_at_once=60)) == expected


def test_query_equals_the_plain_pass(spark, sf_dir, coders):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [tuple(r) for r in rows if len(r["text"]) < 3000]
    df = spark.createDataFrame(short, "doc_id bigint, text string")
    assert len(short) > 100
    assert found(alignment.align_documents(df, A, B)) == plain(coders, short)
    whole = found(llm_queries()["op13_alignment"](spark, sf_dir))
    assert [r[0] for r in whole] == sorted((r["doc_id"] for r in rows), key=str)
    digests = {r[0]: r[1:5] + r[-1:] for r in found(alignment.align_documents(df, A, B))}
    assert all(r[1:5] + r[-1:] == digests[r[0]] for r in whole if r[0] in digests)


def test_odd_rows_and_no_rows(spark, odd_docs, no_docs, odd_rows):
    let_workers_import(spark)
    rows = alignment.align_documents(odd_docs, A, B).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[5]["n_a"] == by_id[6]["n_links"] == 0 and by_id[5]["groups_sha256"] == ""
    assert by_id[9]["n_links"] >= max(by_id[9]["n_a"], by_id[9]["n_b"]) > 30_000
    assert by_id[3]["groups_sha256"] == by_id[4]["groups_sha256"] != "" and by_id[3]["n_a"] > 0
    assert alignment.align_documents(no_docs, A, B).count() == 0
