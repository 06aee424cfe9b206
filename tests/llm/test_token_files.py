from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from windrow.llm import frame_of_reference as pfor
from windrow.llm import token_files
from windrow.llm.common import new_path
from windrow.llm.registry import END_ID, tokenizer_path


@given(
    st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700),
    st.sampled_from([0.5, 0.9, 0.95, 1.0]),
)
@settings(max_examples=60, deadline=None)
def test_segments_round_trip(ids, percentile):
    whole = pfor.Segment(
        np.array([7]), np.array([1]), np.array([len(ids)]), np.array(ids, dtype=np.uint32)
    )
    back = pfor.decode(pfor.encode(whole, percentile))
    assert back.ids.tolist() == ids and back.doc_ids.tolist() == [7]
    assert back.lengths.tolist() == [len(ids)]


def test_outliers_become_exceptions():
    ids = np.arange(1000, 1000 + pfor.BLOCK, dtype=np.uint32)
    ids[5] = 2**31
    segment = pfor.Segment(np.array([0]), np.array([1]), np.array([len(ids)]), ids)
    assert len(pfor.encode(segment, 0.95)) < len(pfor.encode(segment, 1.0)) / 2
    with pytest.raises(ValueError):
        pfor.decode(b"\0" * 64)


def test_chunks_give_the_ids_of_whole_texts():
    encoder = token_files.ChunkEncoder(tokenizer_path())
    pieces = ["a", "The", "é,", "straße.", " ", "  ", "\n", "\t", "\x1c", "\xa0", "日本", "1", "'s", " '", "!!", "<|endoftext|>", "x."]
    some = random.Random(0)
    texts = ["".join(some.choices(pieces, k=some.randint(0, 12))) for _ in range(5000)]
    for some_texts in (texts, texts[::-1], ["", ""], []):
        ids, counts = encoder.encode(some_texts)
        wanted = [w.ids for w in encoder.tokenizer.encode_batch(some_texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(token_files, "RECENT_ENTRIES", 2)
    encoder = token_files.ChunkEncoder(tokenizer_path())
    for text in ["one two, three four. five", "six seven one two", "one two, three four. five"]:
        ids, _ = encoder.encode([text])
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def expected(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment_ids", [1, 1 << 20])
def test_file_against_plain_encoding(spark, odd_docs, odd_rows, monkeypatch, segment_ids):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment_ids)
    path = new_path(spark, "test-tokens")
    token_files.write_token_file(odd_docs, path, tokenizer_path(), END_ID)
    found = [tuple(r) for r in token_files.token_digests(spark, path).collect()]
    wanted = expected(odd_rows)
    # Rows that share an id may follow one another in either order.
    unique = [w for w in wanted if [r[0] for r in odd_rows].count(w[0]) == 1]
    assert set(unique) <= set(found) and len(found) == len(wanted)
    assert sorted(w[2:] for w in wanted) == sorted(f[2:] for f in found)
    ends = sorted((f[1], f[1] + f[2]) for f in found)
    assert [e for _, e in ends][:-1] == [s for s, _ in ends][1:]
    ids = {r["doc_id"]: r["ids"] for r in token_files.read_token_file(spark, path).collect()}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    assert ids[9] == [*tokenizer.encode(dict(odd_rows)[9], add_special_tokens=False).ids, END_ID]
    assert ids[5] == ids[6] == [END_ID]


def test_no_documents(spark, no_docs):
    path = new_path(spark, "test-tokens")
    token_files.write_token_file(no_docs, path, tokenizer_path(), END_ID)
    assert token_files.token_digests(spark, path).count() == 0
