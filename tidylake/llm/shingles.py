"""Hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np

# Odd constants of the polynomial and of the final mix.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PIECE = 1 << 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)


def _power(table: np.ndarray, base: np.uint64, n: int) -> np.ndarray:
    return table[:n] if n <= len(table) else _powers(base, n)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, A-Z lower-cased."""
    codes = _LOWER[np.frombuffer(data, np.uint8)]
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint64)
    inside = ~_WHITE[codes]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    # prefix sums of a polynomial; a word's is moved back to the text's start
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[codes] * _power(_UP, _BASE, n), out=total[1:])
    return _mix((total[ends] - total[starts]) * _power(_DOWN, _INVERSE, n)[starts]
                + (ends - starts).astype(np.uint64) * _M1)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's ``width``-word shingles, as signed
    integers; a text with fewer words has its whole sequence as one, a text
    without words none."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(words):
        return np.zeros(0, np.int64)
    size = min(width, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64) * _BASE
    for k in range(size):
        total = _mix(total + words[k:len(words) - size + 1 + k])
    return np.unique(total).view(np.int64)
