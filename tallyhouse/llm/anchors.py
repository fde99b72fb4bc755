"""Finding repeated windows of a large corpus without sending every window.

A sequence of units (bytes or words) is looked at through windows of a fixed length. Each window is filed under its
anchor: the run of `gram` units in it whose hash is smallest, the leftmost of equal ones. Equal windows have equal
anchors, and neighbouring windows mostly share one, so a corpus has far fewer anchors than windows. Of each anchor the
stretch of all its windows is hashed as well. An anchor that occurs once has no repeated window; occurrences of one
stretch repeat each other whole; only where an anchor stands in different stretches have their units to be compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# Units hashed at once in a task; bounds its memory whatever the length of a text.
SLICE_UNITS = 1 << 20
_PLACE_BITS = 21
_U = np.uint64
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _MIX[0]
    x = (x ^ (x >> _U(27))) * _MIX[1]
    return x ^ (x >> _U(31))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, _U(b), _U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@lru_cache(maxsize=8)
def byte_marks(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


class Rolling:
    """Hashes of any runs of units, from running sums."""

    def __init__(self, marks: np.ndarray, base: int):
        size = 1 << int(len(marks)).bit_length()
        powers, self._inverse = _powers(base, size)
        self._sums = np.zeros(len(marks) + 1, _U)
        np.cumsum(marks * powers[:len(marks)], out=self._sums[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(_U) * _MIX[0])


BASES = (0x9E3779B97F4A7C15 | 1, 0xD1B54A32D192ED03 | 1)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of the words of a text: runs of other bytes than space and tab to return."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True]))))
    return edge[0::2], edge[1::2]


@dataclass(frozen=True)
class Found:
    """Anchors of one document: hash, hash of their stretch, first window, number of windows."""

    anchor: np.ndarray
    stretch: np.ndarray
    first: np.ndarray
    windows: np.ndarray


def _leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Of each run of `width` values the place of its smallest, the leftmost of equal ones."""
    bits = _PLACE_BITS  # the same for every text, so that ties fall alike
    low = values >> _U(bits) << _U(bits) | np.arange(len(values), dtype=_U)
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    return (low & _U((1 << bits) - 1)).astype(np.int64)


def anchors(marks: Sequence[np.ndarray], window: int, gram: int) -> Found:
    """Anchors of a document, given two independent hashes of each of its units."""
    n = len(marks[0])
    empty = np.zeros(0, np.int64)
    if n < window:
        return Found(empty.astype(_U), empty.astype(_U), empty, empty)
    parts = []
    # A window starts in exactly one slice; windows of one anchor that start in two slices are two entries.
    for at in range(0, n - window + 1, SLICE_UNITS):
        end = min(n, at + SLICE_UNITS + window - 1)
        one, two = Rolling(marks[0][at:end], BASES[0]), Rolling(marks[1][at:end], BASES[1])
        starts = np.arange(end - at - gram + 1)
        place = _leftmost_smallest(one.runs(starts, starts + gram), window - gram + 1)
        head = np.flatnonzero(np.diff(place, prepend=-1))
        count = np.diff(head, append=len(place))
        spot = place[head]
        parts.append((one.runs(spot, spot + gram), two.runs(head, head + count + window - 1), head + at, count))
    return Found(*(np.concatenate(x) for x in zip(*parts)))
