"""Vectorised hashes of words and word shingles over Arrow string columns.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``; A-Z are lower-cased.
White space and A-Z are single bytes in UTF-8, so bytes and code points agree.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240917)
_TABLE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_TABLE[65:91] = _TABLE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(64, 1 << int(n - 1).bit_length())
        p = np.full(size, _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text, and each text's first word (n + 1 entries)."""
    white = _IS_WHITE[data]
    inside = ~white
    first = inside.copy()
    if len(first) > 1:
        first[1:] &= white[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edges] = inside[edges]  # a text's first byte begins a word even without white space before it
    starts_all = np.flatnonzero(first)
    bounds = np.searchsorted(starts_all, offsets)
    if not len(starts_all):
        return np.zeros(0, np.uint64), bounds
    kept = np.flatnonzero(inside)
    starts = np.searchsorted(kept, starts_all)
    lengths = np.diff(np.append(starts, len(kept)))
    at = np.arange(len(kept)) - np.repeat(starts, lengths)
    values = _TABLE[data[kept]] * _powers(int(lengths.max()) + 1)[at]
    return mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64)), bounds


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of one text's n-word shingles; the whole sequence as one if it is shorter."""
    if not len(words):
        return words
    k = min(n, len(words))
    total = np.full(len(words) - k + 1, np.uint64(k))
    for i in range(k):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - k + 1 + i])
    return total


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int):
    """Sorted distinct shingle hashes of each text."""
    words, bounds = word_hashes(data, offsets)
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield np.unique(shingle_hashes(words[a:b], n))
