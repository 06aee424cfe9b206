"""Content-defined anchors of long byte strings (numpy).

Of every 100-byte window the anchor is the 40-byte substring of least hash (the leftmost of
equal ones). Equal windows have equal anchors at equal offsets, so only windows around equal
anchors can be equal; on average one position in 31 is an anchor.
"""

from __future__ import annotations

import numpy as np

from windrow.llm.common import SCRATCH
from windrow.llm.shingles import mix

LENGTH, HEAD = 100, 40
#: Places of a 64-bit key that hold the position; the rest holds the hash.
_PLACE_BITS = np.uint64(28)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []
SCRATCH.append(_powers.clear)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        tables = [np.full(max(size, 1 << 16), base, dtype=np.uint64) for base in (_BASE, _INVERSE)]
        for table in tables:
            table[0] = 1
        _powers[:] = [np.cumprod(table, dtype=np.uint64) for table in tables]
    return _powers[0], _powers[1]


class Fingerprints:
    """Hashes of any substring of ``data``, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[begin + length] - self.sums[begin]) * self.down[begin])


def find_anchors(prints: Fingerprints, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """text, first window, windows, head and context of every anchor of joined texts.

    ``sizes`` are the texts' bytes. An anchor is that of ``windows`` windows in a row, the first
    of which starts at ``first`` (within the text). ``head`` is the hash of its 40 bytes and
    ``context`` that of all bytes of its windows, with the anchor's place among them: equal
    contexts mean that the windows are equal one by one.
    """
    total = int(sizes.sum())
    nothing = np.zeros(0, np.int64)
    if total < LENGTH:
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    n_heads = total - HEAD + 1
    heads = prints.of(np.arange(n_heads), HEAD)
    keys = (heads >> _PLACE_BITS << _PLACE_BITS) | np.arange(n_heads, dtype=np.uint64)
    wide, span = keys, 1
    reach = LENGTH - HEAD + 1
    while span * 2 <= reach:
        wide = np.minimum(wide[: len(wide) - span], wide[span:])
        span *= 2
    rest = reach - span
    least = np.minimum(wide[: len(wide) - rest], wide[rest:]) if rest else wide
    anchor = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    # Window starts whose 100 bytes lie within one text.
    ends = np.cumsum(sizes)
    inside = np.zeros(len(anchor) + 1, dtype=np.int64)
    has = sizes >= LENGTH
    np.add.at(inside, (ends - sizes)[has], 1)
    np.add.at(inside, (ends - LENGTH + 1)[has], -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if len(starts) == 0:
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    at = anchor[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = starts[new]
    windows = np.diff(np.append(np.flatnonzero(new), len(starts)))
    at = at[new]
    context = prints.of(first, windows + LENGTH - 1)
    place = ((at - first) * 256 + windows).astype(np.uint64)
    text = np.searchsorted(ends, first, side="right")
    return text, first - (ends - sizes)[text], windows, heads[at], mix(context + place * np.uint64(_BASE))
