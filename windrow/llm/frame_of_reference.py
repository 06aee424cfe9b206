"""Patched frame-of-reference segments of token ids (numpy only, one segment at a time).

A segment holds the ids of consecutive documents in blocks of 128. Of each block the minimum is
subtracted; the rest is packed at the width that a chosen share of the block's values needs. Of
the outliers the low bits are packed like the others and the high bits go to an exception list.

Layout, little-endian, each part in turn:
    4 bytes b"PFOR", uint32 documents D, uint32 blocks B, uint32 exceptions E, uint64 ids
    int64[D] document ids, uint8[D] whether the id is given, uint64[D] ids per document
    uint32[B] minimum, uint8[B] width, uint64[B + 1] first packed word of each block,
    uint32[B + 1] first exception of each block
    uint64[...] packed words, uint8[E] places in the block, uint32[E] high bits
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

BLOCK = 128
_HEAD = struct.Struct("<4sIIIQ")
_MAGIC = b"PFOR"
_SHORT_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


@dataclass
class Segment:
    doc_ids: np.ndarray
    given: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; values are below 2**32, so the exponent is exact."""
    if values.size and values.max() < len(_SHORT_BITS):
        return _SHORT_BITS[values]
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(columns: np.ndarray, width: int) -> np.ndarray:
    """(BLOCK, n) values below 2**width to (n, 2 * width) words."""
    words = np.zeros((2 * width, columns.shape[1]), dtype=np.uint64)
    for place in range(BLOCK):
        word, shift = divmod(place * width, 64)
        words[word] |= columns[place] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[place] >> np.uint64(64 - shift)
    return words.T


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """(n, 2 * width) words to (BLOCK, n) values."""
    words = np.ascontiguousarray(words.T)
    mask = np.uint64((1 << width) - 1)
    columns = np.empty((BLOCK, words.shape[1]), dtype=np.uint64)
    for place in range(BLOCK):
        word, shift = divmod(place * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        columns[place] = value & mask
    return columns


def encode(segment: Segment, percentile: float = 0.95) -> bytes:
    """``percentile`` is the share of a block's values that its width must hold."""
    ids = np.ascontiguousarray(segment.ids, dtype=np.uint32)
    n_blocks = -(-len(ids) // BLOCK)
    padded = np.zeros(n_blocks * BLOCK, dtype=np.uint32)
    padded[: len(ids)] = ids
    if len(ids):
        padded[len(ids) :] = ids[-1]
    blocks = padded.reshape(n_blocks, BLOCK)
    minima = blocks.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rest = blocks - minima[:, None]
    bits = _bit_lengths(rest)
    rank = max(0, int(np.ceil(percentile * BLOCK)) - 1)
    widths = np.partition(bits, rank, axis=1)[:, rank] if n_blocks else np.zeros(0, np.uint8)
    word_starts = np.zeros(n_blocks + 1, dtype=np.uint64)
    np.cumsum(2 * widths.astype(np.uint64), out=word_starts[1:])
    words = np.zeros(int(word_starts[-1]), dtype=np.uint64)
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        low = rest[at] & np.uint32((1 << width) - 1)
        places = word_starts[at].astype(np.int64)[:, None] + np.arange(2 * width)
        words[places] = _pack(np.ascontiguousarray(low.T).astype(np.uint64), width)
    block, place = np.nonzero(bits > widths[:, None])
    high = (rest[block, place].astype(np.uint64) >> widths[block].astype(np.uint64)).astype(np.uint32)
    exception_starts = np.zeros(n_blocks + 1, dtype=np.uint32)
    np.cumsum(np.bincount(block, minlength=n_blocks), out=exception_starts[1:])
    parts = [
        _HEAD.pack(_MAGIC, len(segment.doc_ids), n_blocks, len(block), len(ids)),
        segment.doc_ids.astype("<i8"), segment.given.astype("u1"), segment.lengths.astype("<u8"),
        minima.astype("<u4"), widths.astype("u1"), word_starts.astype("<u8"),
        exception_starts.astype("<u4"), words.astype("<u8"), place.astype("u1"), high.astype("<u4"),
    ]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


def decode(data: bytes) -> Segment:
    magic, n_docs, n_blocks, n_exceptions, n_ids = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a segment of token ids")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, dtype=kind, count=count, offset=at)
        at += found.nbytes
        return found

    doc_ids, given, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)
    minima, widths = take("<u4", n_blocks), take("u1", n_blocks)
    word_starts, exception_starts = take("<u8", n_blocks + 1), take("<u4", n_blocks + 1)
    words = take("<u8", int(word_starts[-1]))
    place, high = take("u1", n_exceptions), take("<u4", n_exceptions)
    rest = np.zeros((n_blocks, BLOCK), dtype=np.uint32)
    for width in np.unique(widths[widths > 0]).tolist():
        found = np.flatnonzero(widths == width)
        places = word_starts[found].astype(np.int64)[:, None] + np.arange(2 * width)
        rest[found] = _unpack(words[places], width).T
    block = np.repeat(np.arange(n_blocks), np.diff(exception_starts.astype(np.int64)))
    patch = high.astype(np.uint64) << widths[block].astype(np.uint64)
    rest[block, place] |= patch.astype(np.uint32)
    ids = (rest + minima[:, None]).reshape(-1)[:n_ids]
    return Segment(doc_ids, given, lengths, ids)
