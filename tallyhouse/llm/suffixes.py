"""Suffix order and common prefixes by induced sorting with disk-backed queues.

Suffixes of a text fall into those smaller and those larger than the suffix after them. The leftmost of each run of
smaller ones are sorted first, by naming the pieces between them and sorting the text of names in the same way. All
others are induced: suffixes leave a priority queue in order, and each puts the suffix one position to its left into
the queue. The queue's key is the first symbol and the order of arrival, so it is a first-in-first-out list for each
symbol; lists are moved to disk when they outgrow the memory allowed. Common prefixes travel along: two suffixes
that a symbol was put before share one symbol more than the least of what lies between the two they came from.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict

import numpy as np

from tallyhouse.llm.anchors import BASES, Rolling, mixed

# With fewer entries a symbol than this the recursion ends in doubling: lists get too short for whole-list steps.
_LONG_LISTS = 64
# Bytes of queued tuples held in memory; more are moved to a file of the task, which goes with it.
QUEUE_BYTES = 32 << 20


class InductionQueue:
    """Lists of (position, common prefix with the one before) per symbol, in order of arrival."""

    def __init__(self, limit: int = QUEUE_BYTES):
        self._limit, self._held = limit, 0
        self._lists: dict[int, list] = defaultdict(list)
        self._tail: dict[int, int] = {}
        self._file = None

    def tail(self, symbol: int) -> int | None:
        """The position that was put last into the list of a symbol."""
        return self._tail.get(symbol)

    def put(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        self._lists[symbol].append((positions, common))
        self._tail[symbol] = int(positions[-1])
        self._held += positions.nbytes + common.nbytes
        if self._held > self._limit:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile(prefix="induction-")
        self._file.seek(0, 2)
        for parts in self._lists.values():
            for i, part in enumerate(parts):
                if len(part) == 2:
                    at = self._file.tell()
                    part[0].astype(np.int32).tofile(self._file)
                    part[1].astype(np.uint8).tofile(self._file)
                    parts[i] = (at, len(part[0]), None)
        self._held = 0

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a symbol so far, in order; they leave the queue."""
        positions, common = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
        for part in self._lists.pop(symbol, ()):
            if len(part) == 3:
                self._file.seek(part[0])
                positions.append(np.fromfile(self._file, np.int32, part[1]))
                common.append(np.fromfile(self._file, np.uint8, part[1]))
            else:
                self._held -= part[0].nbytes + part[1].nbytes
                positions.append(part[0])
                common.append(part[1])
        return np.concatenate(positions), np.concatenate(common)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one, a lone smallest symbol, counts as smaller."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    out = np.zeros(n, bool)
    up = text[change] < text[change + 1]
    # All of a run of one symbol goes the way of its last one.
    out[:n - 1] = np.repeat(np.append(up, False), np.diff(np.concatenate(([-1], change, [n - 2]))))[:n - 1] if n > 1 else False
    out[n - 1] = True
    return out


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at `a` and `b`, at most `limit`, symbol by symbol."""
    length = np.zeros(len(a), np.uint8)
    going, i, j = np.arange(len(a)), a, b
    for k in range(limit):
        # The last symbol stands nowhere else, so of two suffixes neither runs past the end before they differ.
        same = text[i] == text[j]
        going, i, j = going[same], i[same] + 1, j[same] + 1
        if not len(going):
            break
        length[going] = k + 1
    return length


class _Least:
    """Range minimum over a short array, by doubling."""

    def __init__(self, values: np.ndarray):
        self._levels = [values]
        size = 1
        while 2 * size <= len(values):
            last = self._levels[-1]
            self._levels.append(np.minimum(last[:-size], last[size:]))
            size *= 2

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Smallest of values[a + 1 .. b] for each pair a < b."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), self._levels[0].dtype)
        for k in np.unique(level):
            on = level == k
            values = self._levels[k]
            out[on] = np.minimum(values[a[on] + 1], values[b[on] + 1 - (1 << int(k))])
        return out


def _induce(text: np.ndarray, smaller: np.ndarray, seeds: dict[int, tuple[np.ndarray, np.ndarray]], downward: bool,
            limit: int, queue_bytes: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """One pass over the symbols. `seeds`: suffixes known in order, per symbol, that are passed on but not returned.

    Upward it finds the larger suffixes from the leftmost smaller ones; downward the smaller ones from the larger ones.
    Lists are in the order of the pass, the common prefix is with the entry before it in that order.
    """
    queue, out = InductionQueue(queue_bytes), {}
    want = ~smaller if not downward else smaller
    symbols = np.unique(text)

    def pass_on(symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        on = np.flatnonzero(positions > 0)
        on = on[want[positions[on] - 1]]
        before = text[positions[on] - 1]
        order = np.argsort(before, kind="stable")
        on, before = on[order], before[order]
        if not len(on):
            return
        new, shared = positions[on] - 1, np.zeros(len(on), np.uint8)
        head = np.append(True, before[1:] != before[:-1])
        if limit:
            inner = np.flatnonzero(~head)
            if len(inner):
                least = _Least(common).between(on[inner - 1], on[inner])
                shared[inner] = np.minimum(least.astype(np.int64) + 1, limit)
        edges = np.append(np.flatnonzero(head), len(on))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            target = int(before[a])
            last = queue.tail(target)
            if limit and last is not None:
                shared[a] = common_prefix(text, np.array([last]), new[a:a + 1], limit)[0]
            queue.put(target, new[a:b], shared[a:b])

    for symbol in (symbols[::-1] if downward else symbols).tolist():
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            # Entries that put one of the same symbol before themselves come back in the next round.
            positions, common = queue.take(symbol)
            if not len(positions):
                break
            parts.append((positions, common))
            pass_on(symbol, positions, common)
        if symbol in seeds:
            pass_on(symbol, *seeds[symbol])
        if parts:
            out[symbol] = tuple(np.concatenate(x) for x in zip(*parts))
    queue.close()
    return out


def _by_symbol(text: np.ndarray, positions: np.ndarray, common: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    first = text[positions]
    edges = np.concatenate(([0], np.flatnonzero(first[1:] != first[:-1]) + 1, [len(first)]))
    return {int(first[a]): (positions[a:b], common[a:b]) for a, b in zip(edges[:-1], edges[1:]) if b > a}


def _doubled(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by at least the first `depth` symbols, by doubling: the end of the recursion."""
    n, size = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:n - size] += rank[size:] + 1  # nothing follows the last ones
        order = np.argsort(key)
        key = key[order]
        new = np.append(False, key[1:] != key[:-1])
        rank[order] = np.cumsum(new)
        size *= 2
        if size >= depth or rank[order[-1]] == n - 1:
            return order


def sorted_suffixes(text: np.ndarray, limit: int, queue_bytes: int = QUEUE_BYTES, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the suffixes in order, and the common prefix of each with the one before, counted up to `limit`.

    `text` holds whole numbers and ends in one that is smaller than all others. Order is promised by the first `depth` symbols (`limit`
    if not given): suffixes that agree so far may stand in any order.
    """
    if limit > 255 or len(text) >= 2 ** 31:
        raise ValueError("common prefixes are counted in one byte, positions in four")
    depth = depth or limit
    n = len(text)
    smaller = _smaller(text)
    seeds = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    if len(seeds):
        ordered = _order_of_seeds(text, smaller, seeds, depth, queue_bytes)
    else:
        ordered = np.array([n - 1], np.int32)
    common = np.zeros(len(ordered), np.uint8)
    if limit:
        common[1:] = common_prefix(text, ordered[:-1], ordered[1:], limit)
    larger = _induce(text, smaller, _by_symbol(text, ordered, common), False, limit, queue_bytes)
    # Downward, lists run from the largest: each common prefix moves to its other neighbour.
    turned = {s: (p[::-1], np.append(np.zeros(1, np.uint8), c[:0:-1])) for s, (p, c) in larger.items()}
    lesser = _induce(text, smaller, turned, True, limit, queue_bytes)
    positions, shared = [], []
    for symbol in np.unique(text).tolist():
        if symbol in larger:
            positions.append(larger[symbol][0])
            shared.append(larger[symbol][1])
        if symbol in lesser:
            p, c = lesser[symbol]
            positions.append(p[::-1])
            shared.append(np.append(np.zeros(1, np.uint8), c[:0:-1]))
    missing = np.zeros(n, bool)
    order, shared = np.concatenate(positions) if positions else np.zeros(0, np.int32), np.concatenate(shared) if shared else np.zeros(0, np.uint8)
    missing[order] = True
    rest = np.flatnonzero(~missing).astype(np.int32)  # the last suffix, which no other induces
    order, shared = np.concatenate((rest, order)), np.concatenate((np.zeros(len(rest), np.uint8), shared))
    if limit:
        # Where lists meet nothing was carried over: compare the few neighbours there.
        meet = np.cumsum([len(rest), *map(len, positions)])[:-1]
        meet = meet[(meet > 0) & (meet < n)]
        shared[meet] = common_prefix(text, order[meet - 1], order[meet], limit)
    return order, shared


def _order_of_seeds(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, depth: int, queue_bytes: int) -> np.ndarray:
    """The leftmost smaller suffixes in order: name the pieces between them, sort the text of names."""
    none = np.zeros(len(seeds), np.uint8)
    by_symbol = _by_symbol(text, seeds[np.argsort(text[seeds], kind="stable")], none)
    larger = _induce(text, smaller, by_symbol, False, 0, queue_bytes)
    lesser = _induce(text, smaller, {s: (p[::-1], c) for s, (p, c) in larger.items()}, True, 0, queue_bytes)
    is_seed = np.zeros(len(text), bool)
    is_seed[seeds] = True
    lists = [lesser[s][0][::-1] for s in sorted(lesser)]
    order = np.concatenate([seeds[-1:], *lists]) if lists else seeds[-1:]
    order = order[is_seed[order]]
    order = np.append(order[:1], order[1:][order[1:] != seeds[-1]])
    # Equal pieces share a name; a piece runs from a seed through the first symbol of the next one.
    end = np.full(len(text), len(text), np.int64)
    end[seeds[:-1]] = seeds[1:] + 1
    marks = mixed(text.astype(np.uint64) + np.uint64(1))
    hashes = [Rolling(marks, base).runs(order, end[order]) for base in BASES]
    size = end[order] - order
    new = np.append(False, (size[1:] != size[:-1]) | (hashes[0][1:] != hashes[0][:-1]) | (hashes[1][1:] != hashes[1][:-1]))
    name = np.zeros(len(text), np.int64)
    name[order] = np.cumsum(new)
    names = name[seeds]
    count = int(names.max()) + 1
    if count == len(seeds):
        return order
    depth = depth // 2 + 2  # a piece is at least two symbols long
    if count * _LONG_LISTS <= len(seeds):
        return seeds[sorted_suffixes(names, 0, queue_bytes, depth)[0]]
    return seeds[_doubled(names, depth)]
