"""Word tables of many texts at once, as numpy arrays inside a task.

Words are runs of ASCII digits, letters and all non-ASCII characters, after
A-Z became a-z; everything else separates them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
SLICE_BYTES = 2 << 20      # texts taken together

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64; those of usual slices are kept."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        got = np.full(n, base, np.uint64)
        got[:1] = 1
        got = np.cumprod(got, dtype=np.uint64)
        if n <= SLICE_BYTES + 1:
            _POWERS[base] = got
    return got[:n]


def text_slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows holding about ``most``
    bytes, at least one row each. A null text is empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


@dataclass
class Words:
    """``start`` / ``end``: byte ranges in ``lower``; ``doc``: row of each
    word; ``first``: index of each row's first word, plus the total."""

    lower: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def words_of(data: np.ndarray, off: np.ndarray) -> Words:
    lower = _LOWER[data]
    n = len(lower)
    inside = _IN_WORD[lower]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[off] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * powers(n), out=sums[1:])
    inverse = pow(BASE, -1, 1 << 64)
    hashes = mix((sums[end] - sums[start]) * powers(n + 1, inverse)[start])
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(lower, start, end, doc, first, hashes)


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether they are of one text."""
    n = len(w.start) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + w.hashes[j:j + n]
    return mix(h + np.uint64(k)), w.doc[:n] == w.doc[k - 1:]
