"""Word shingles of many texts at once, as 64-bit hashes (numpy)."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240229)
#: Random numbers for bytes, for places in a word, and for places in a shingle.
_BYTES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_PLACES = _RANDOM.integers(0, 2**64, 4096, dtype=np.uint64) | np.uint64(1)
_ORDER = _RANDOM.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
for _upper in range(65, 91):
    _BYTES[_upper] = _BYTES[_upper + 32]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: list[str], separators: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+``, A-Z read as a-z, and words per text.

    ``separators`` are further bytes that part words.
    """
    is_space = _IS_SPACE.copy()
    is_space[list(separators)] = True
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    blank = is_space[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
    begins, ends = edges[::2], edges[1::2]
    if len(begins) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = ends - begins
    keep = ~blank
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    if lengths.max() > len(_PLACES):
        factor = _PLACES[place % len(_PLACES)] * (2 * (place // len(_PLACES)) + 1).astype(np.uint64)
    else:
        factor = _PLACES[place]
    sums = np.add.reduceat(_BYTES[data[keep]] * factor, np.cumsum(lengths) - lengths)
    sizes = np.array([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(begins, np.append(0, np.cumsum(sizes))))
    return mix(sums + lengths.astype(np.uint64)), counts


def shingle_sets(texts: list[str], words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text.

    A shorter text with words has one shingle of all of them; one without words has none.
    """
    hashes, counts = word_hashes(texts)
    size = len(hashes)
    full = max(0, size - words + 1)
    sums = np.zeros(full, dtype=np.uint64)
    for k in range(words):
        sums += hashes[k : k + full] * _ORDER[k]
    sums = mix(sums)
    out = []
    starts = np.cumsum(counts) - counts
    for start, count in zip(starts.tolist(), counts.tolist(), strict=True):
        if count >= words:
            out.append(np.unique(sums[start : start + count - words + 1]))
        elif count:
            whole = (hashes[start : start + count] * _ORDER[8 : 8 + count]).sum(dtype=np.uint64)
            out.append(mix(np.array([whole + np.uint64(count)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
