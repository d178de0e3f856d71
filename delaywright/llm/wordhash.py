"""Hashes of the words and word windows of many texts at once, in numpy.

Words are runs of bytes other than blank and U+0009 to U+000D. A word's hash is a polynomial over
a random table of its bytes, taken from one running sum over the whole slice; a window's hash is a
polynomial over its words' hashes. Both end in a mixing step.
"""

from __future__ import annotations

import numpy as np

#: The separators between words (fixed values).
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_C1, _C2, _C3 = (np.uint64(c) for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 21)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def _table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _C3 + np.uint64(seed << 40))


def words(data: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, bounds) of a slice of texts: word i is ``bytes[starts[i]:ends[i]]``,
    text j has words ``bounds[j]`` to ``bounds[j + 1]``."""
    joined = b" ".join(data) + b" "
    if lower:
        joined = joined.translate(_LOWER)
    raw = np.frombuffer(joined, dtype=np.uint8)
    blank = _BLANK[raw]
    inside = ~blank
    starts = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(blank & np.concatenate([[False], inside[:-1]]))
    offsets = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
    return raw, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """One 64-bit hash for each word; other seeds give independent ones."""
    running = np.empty(len(raw) + 1, dtype=np.uint64)
    running[0] = 0
    np.cumsum(_table(seed)[raw] * _power(_BASE, len(raw)), out=running[1:])
    return mix((running[ends] - running[starts]) * _power(_INVERSE, len(raw) + 1)[starts])


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of every ``size`` consecutive entries, by their first."""
    size = int(size)
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    state = np.full(n, (seed * int(_C3) + size) % (1 << 64), dtype=np.uint64)
    for k in range(size):
        state = state * np.uint64(_BASE) + hashes[k : k + n]
    return mix(state)


def starts_within(bounds: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the ``n`` windows of ``size`` words lie inside one text."""
    ok = np.zeros(n, dtype=bool)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            ok[a : b - size + 1] = True
    return ok
