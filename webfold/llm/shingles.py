"""Word shingles of a text as sorted distinct 64-bit tokens.

Words are runs of anything but ASCII white space, with A-Z lower-cased.  On
UTF-8 bytes both rules are byte rules, so a text is normalised with C-speed
``bytes`` methods and hashed with numpy: a polynomial hash over the bytes of
``width`` consecutive words (joined by single spaces), then mixed.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 1 << 18  # bytes hashed at a time, so a very long text needs bounded scratch

_power = _inverse = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _inverse
    if len(_power) < n:
        size = max(n, 2 * len(_power))
        both = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _power, _inverse = both
    return _power, _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def runs(words: list[bytes], width: int) -> np.ndarray:
    """Unsigned 64-bit hash of each run of ``width`` consecutive words, in order."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1)  # each word with the space after it
    parts = []
    first = 0
    while first + width <= len(words):
        offset = int(ends[first - 1]) if first else 0
        last = max(int(np.searchsorted(ends, offset + _STEP)), first + width)  # words first..last-1
        data = np.frombuffer(b" ".join(words[first:last]), np.uint8).astype(np.uint64)
        power, inverse = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * power[: len(data)], out=sums[1:])
        stop = ends[first:last] - 1 - offset
        start = stop - lengths[first:last]
        start, stop = start[: len(start) - width + 1], stop[width - 1:]
        parts.append((sums[stop] - sums[start]) * inverse[start])
        first += len(start)
    return mix(np.concatenate(parts))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct signed 64-bit shingle tokens; fewer words than ``width`` make one; none, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(runs(words, min(width, len(words))).view(np.int64)) if words else np.empty(0, np.int64)
