"""Vectorised work on many UTF-8 texts at once: word spans, polynomial hashes of any span, winnowed anchors.

All functions take the bytes of several texts laid end to end with their offsets; nothing crosses from one text to the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Byte classes: true where a byte belongs to a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Tables of base ** i mod 2 ** 64, made as long as they are needed; copies that travel to tasks start empty."""

    def __init__(self) -> None:
        self.tables: dict[int, np.ndarray] = {}

    def __reduce__(self):
        return (_Powers, ())

    def __call__(self, base: int, n: int) -> np.ndarray:
        if base not in self.tables or len(self.tables[base]) < n:
            table = np.full(max(n, 1 << 16), base, np.uint64)
            table[0] = 1
            self.tables[base] = np.cumprod(table, dtype=np.uint64)
        return self.tables[base][:n]


_power = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit hashes over all others (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hash` reads the hash of any span of ``values`` (unsigned integers)."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(values)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans ``[start, end)``: equal spans have equal hashes wherever they stand."""
    return mixed((sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start])


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, ends, bounds``: byte spans of all words, and for each text the index of its first word (one more at the end)."""
    inside = member[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def anchors(sums: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing over values (bytes or words): for each run of consecutive windows that share their anchor, ``first, last, at, h``.

    A window is ``window`` values of one text; its anchor is the gram in it with the least hash, the leftmost of equals, so
    windows with equal contents have their anchor at the same place. ``first`` and ``last`` are the starts of the run's
    windows, ``at`` is where the anchor's gram starts, ``h`` its hash. ``bounds``: where each text starts, and the end.
    """
    n = len(sums) - 1
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none.astype(np.uint64)
    start = np.arange(n - gram + 1)
    h = span_hash(sums, start, start + gram)
    # the upper half of the hash decides, the lower half is the place: the least value is the leftmost of the least
    best = (h & np.uint64(0xFFFFFFFF00000000)) | start.astype(np.uint64)
    width, have = window - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    ok = np.zeros(n + 1, np.int32)  # starts of windows that lie in one text
    length = np.diff(bounds)
    full = length >= window
    np.add.at(ok, bounds[:-1][full], 1)
    np.add.at(ok, bounds[1:][full] - window + 1, -1)
    starts = np.flatnonzero(np.cumsum(ok)[: len(best)] > 0)
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    at = (best[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero((at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first, last = np.r_[0, change], np.r_[change, len(at)] - 1
    return starts[first], starts[last], at[first], h[at[first]]


def grouped(h: np.ndarray, doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """Values of one hash in one text as a list: ``h, doc, lists``, in order of text and hash."""
    order = np.lexsort((value, h, doc))
    h, doc, value = h[order], doc[order], value[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, np.int64)
    return h[first], doc[first], pa.ListArray.from_arrays(pa.array(np.r_[first, len(h)].astype(np.int32)), pa.array(value))
