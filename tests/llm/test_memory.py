"""Tables of workers go when another operator's task starts or their own ends."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from made_up import prose

from windrow.llm import anchors, common, token_files
from windrow.llm.registry import tokenizer_path


def batch(n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(n))], names=["x"])


def test_slices_keep_all_rows():
    sliced = list(common.in_slices(iter([batch(5), batch(0), batch(2)]), 2))
    assert [b.num_rows for b in sliced] == [2, 2, 1, 2]
    assert [x for b in sliced for x in b.column(0).to_pylist()] == [0, 1, 2, 3, 4, 0, 1]


def test_an_encoder_lives_until_another_operator_comes():
    encoder = token_files._encoder(tokenizer_path())
    list(common.released(iter, "token_files")(iter([batch(1)])))
    assert token_files._encoder(tokenizer_path()) is encoder
    list(common.released(iter)(iter([batch(1)])))
    assert token_files._encoder(tokenizer_path()) is not encoder


def test_power_tables_go_with_the_task():
    def task(batches):
        anchors.Fingerprints(np.zeros(10, np.uint8))
        assert anchors._powers
        yield from batches

    assert [b.num_rows for b in common.released(task)(iter([batch(3)]))] == [3]
    assert not anchors._powers
    prints = anchors.Fingerprints(np.arange(50, dtype=np.uint8) % 7)
    assert prints.of(np.array([0, 7]), 5)[0] == prints.of(np.array([0, 7]), 5)[1]


def test_a_batch_of_texts_is_encoded_in_little_memory():
    texts = [prose(k, 400) for k in range(token_files.ENCODE_DOCS)]
    encoder = token_files.ChunkEncoder(tokenizer_path())
    encoder.encode(texts)
    tracemalloc.start()
    encoder.encode(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 12_000_000
