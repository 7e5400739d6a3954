"""Whole Arrow text columns as flat numpy arrays: word bounds and word hashes without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D, the same as ``[^\\x20\\x09-\\x0D]+`` on the decoded text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_BASES = [(p, pow(p, -1, 2**64)) for p in (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)]
_powers: dict[str, np.ndarray] = {}


def flatten(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text makes a range alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (one more at the end)."""
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    filled = offsets[1:] > offsets[:-1]
    at = offsets[:-1][filled]
    first[at] = solid[at]
    at = offsets[1:][filled] - 1
    last[at] = solid[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser over 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(n: int, base: int, key: str) -> np.ndarray:
    """Powers of an odd base, kept between calls; the array doubles when a long text needs more."""
    known = _powers.get(key)
    if known is None or len(known) < n:
        known = np.full(1 << max(n, 1 << 16).bit_length(), base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if n <= 4 * SLICE_BYTES:
            _powers[key] = known
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over the bytes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(len(data), _STEP, "up"), out=total[1:])
    own = (total[ends] - total[starts]) * _power(len(data) + 1, _BACK, "down")[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(words: np.ndarray, width: int, at: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of the ``width`` word hashes from each index in ``at``; ``which`` picks one of two independent families."""
    base, back = _BASES[which]
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _power(len(words), base, f"up{which}"), out=total[1:])
    return mix((total[at + width] - total[at]) * _power(len(words) + 1, back, f"down{which}")[at])


def windows_inside(firsts: np.ndarray, width: int) -> np.ndarray:
    """Indexes of the windows that stay in one text, given each text's first word."""
    words = int(firsts[-1])
    if words < width:
        return np.zeros(0, np.int64)
    room = np.repeat(firsts[1:], np.diff(firsts))
    at = np.arange(words - width + 1)
    return at[at + width <= room[:len(at)]]


def owners(firsts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text of each word index."""
    return np.searchsorted(firsts, at, "right") - 1
