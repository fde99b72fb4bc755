"""Windows that occur more than once in a corpus: Spark steps shared by the two substring operators.

1. A scan gives the anchors of each document. Equal (anchor, stretch) pairs are folded in the task first, so a passage
   that a third of all rows share costs a few rows for each task.
2. Anchors are dealt out by hash and sorted; a stream over each partition settles what needs no text: anchors that
   stand once, and stretches that repeat whole.
3. Where an anchor stands in different stretches, one of each is fetched from its document and sent to the anchor's
   shard. An anchor with very many stretches sends single windows instead, told apart by two hashes and dealt by one of
   them. Equal ones are folded in the task first, as stretches are, so a window costs each task one row.
4. Each shard compares the units of its stretches. How is the operator's own business. Rows of single windows are merged
   in a stream and not held, so no shard grows with the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.anchors import BASES, Found, Rolling, anchors, byte_marks, word_bounds
from tallyhouse.llm.common import KEY, written

# Anchors folded at once in a task.
FOLD_ROWS = 400_000
# An anchor with more stretches than this is settled window by window.
HOT_STRETCHES = 2_000
_BY_DOCUMENT = 0x5851F42D4C957F2D
# Bytes of a word above which its marks are a cryptographic digest.
_LONG_WORD = 64
_SEEDS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)

WHOLE, STRETCH, SINGLES = 1, 2, 3


class Bytes:
    """Units are the bytes of a text."""

    def __init__(self, text: bytes):
        self.text, data = text, np.frombuffer(text, np.uint8)
        self.marks = [byte_marks(seed)[data] for seed in _SEEDS]

    def piece(self, first: int, end: int) -> bytes:
        return self.text[first:end]


class Words:
    """Units are the words of a text, split at space and tab to carriage return; up to two marks each."""

    def __init__(self, text: bytes, marks: int = 2):
        self.text, data = text, np.frombuffer(text, np.uint8)
        self.starts, self.ends = word_bounds(data)
        self.marks = [Rolling(byte_marks(seed)[data], base).runs(self.starts, self.ends) for seed, base in zip(_SEEDS[:marks], BASES)]
        # Sums of powers lose bits on long words that repeat a pattern with its letters swapped, whatever the base.
        for k in np.flatnonzero(self.ends - self.starts > _LONG_WORD).tolist():
            digest = hashlib.blake2b(text[self.starts[k]:self.ends[k]], digest_size=16).digest()
            for marks, mark in zip(self.marks, np.frombuffer(digest, np.uint64)):
                marks[k] = mark

    def piece(self, first: int, end: int) -> bytes:
        return self.text[self.starts[first]:self.ends[end - 1]]


@dataclass(frozen=True)
class Windows:
    """What is looked for. `spare_first`: the first occurrence of a window is no repeat, else all of them are."""

    units: type
    window: int
    gram: int
    spare_first: bool
    hot: int = HOT_STRETCHES


@dataclass
class Piece:
    """A stretch in a shard: its units, where it stands, and how often the same stretch occurs."""

    data: bytes
    key: int
    first: int
    windows: int
    copies: int


# Of the pieces of a shard, for each the windows that are repeated.
Compare = Callable[[Sequence[Piece]], list[np.ndarray]]

_ANCHOR = pa.schema([("anchor", pa.int64()), ("stretch", pa.int64()), (KEY, pa.int64()), ("first", pa.int64()), ("windows", pa.int32()), ("copies", pa.int32())])
_ANCHOR_SQL = f"anchor long, stretch long, {KEY} long, first long, windows int, copies int"
_VERDICT = pa.schema([("anchor", pa.int64()), (KEY, pa.int64()), ("first", pa.int64()), ("windows", pa.int32()), ("copies", pa.int32()), ("verdict", pa.int8())])
_VERDICT_SQL = f"anchor long, {KEY} long, first long, windows int, copies int, verdict byte"
_PIECE = pa.schema([("shard", pa.int64()), ("mark", pa.int64()), (KEY, pa.int64()), ("first", pa.int64()), ("windows", pa.int32()), ("copies", pa.int32()), ("data", pa.binary())])
_PIECE_SQL = f"shard long, mark long, {KEY} long, first long, windows int, copies int, data binary"
_REPEAT = pa.schema([(KEY, pa.int64()), ("first", pa.int64()), ("windows", pa.int32())])
_REPEAT_SQL = f"{KEY} long, first long, windows int"
_BATCH = 50_000


def _batches(schema: pa.Schema, columns: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), _BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(c[at:at + _BATCH].astype(f.type.to_pandas_dtype())) for c, f in zip(columns, schema)], schema=schema)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _folded(held: list[tuple[int, Found]], spec: Windows) -> Iterator[pa.RecordBatch]:
    """One row per (anchor, stretch) with its first place here and its number; the other places as settled rows."""
    keys = np.concatenate([np.full(len(f.first), key, np.int64) for key, f in held])
    anchor, stretch = (_signed(np.concatenate([getattr(f, n) for _, f in held])) for n in ("anchor", "stretch"))
    first, windows = (np.concatenate([getattr(f, n) for _, f in held]).astype(np.int64) for n in ("first", "windows"))
    order = np.lexsort((first, keys, stretch, anchor))
    anchor, stretch, keys, first, windows = (x[order] for x in (anchor, stretch, keys, first, windows))
    head = np.ones(len(order), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (stretch[1:] != stretch[:-1])
    copies = np.diff(np.append(np.flatnonzero(head), len(order)))
    lone = np.zeros(len(order), np.int64)
    lone[head] = copies
    # A place that is not the first here repeats it for certain; it is dealt by document, not to the hot anchor.
    route = np.where(head, anchor, keys * np.int64(_BY_DOCUMENT))
    yield from _batches(_ANCHOR, [route, stretch, keys, first, windows, lone])


def _scan(spec: Windows):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = anchors(spec.units(text.as_py() or b"").marks, spec.window, spec.gram)
                if len(found.first):
                    held.append((key, found))
                    rows += len(found.first)
                if rows >= FOLD_ROWS:
                    yield from _folded(held, spec)
                    held, rows = [], 0
        if held:
            yield from _folded(held, spec)
    return scan


def _settle(spec: Windows):
    """Over rows sorted by anchor, stretch, key and place."""
    def settled(rows: list[np.ndarray], hot_anchors: Sequence[int]) -> Iterator[pa.RecordBatch]:
        anchor, stretch, key, first, windows, copies = rows
        done = copies == 0
        yield from _batches(_VERDICT, [x[done] for x in (anchor, key, first, windows, copies)] + [np.full(int(done.sum()), WHOLE)])
        anchor, stretch, key, first, windows, copies = (x[~done] for x in rows)
        if not len(anchor):
            return
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new = new_anchor | np.append(True, stretch[1:] != stretch[:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(copies, at)
        group = np.cumsum(new_anchor)[at] - 1
        stretches = np.bincount(group)[group]
        hot = (stretches > spec.hot) | np.isin(anchor[at], np.array(hot_anchors, np.int64))
        # Repeats: all places but the first of a stretch, or all places if its first one is no exception.
        whole = ~new if spec.spare_first else (total > 1)[np.cumsum(new) - 1]
        yield from _batches(_VERDICT, [x[whole] for x in (anchor, key, first, windows, copies)] + [np.full(int(whole.sum()), WHOLE)])
        ask = (stretches > 1) | hot
        pick = at[ask]
        yield from _batches(_VERDICT, [x[pick] for x in (anchor, key, first, windows)] + [total[ask], np.where(hot[ask], SINGLES, STRETCH)])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None
        hot: list[int] = []
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if not len(rows[0]):
                continue
            if carry is not None:
                rows = [np.concatenate(x) for x in zip(carry, rows)]
            anchor, stretch = rows[0], rows[1]
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if len(anchor) - cut > 4 * spec.hot:
                # Too many places of one anchor to hold: go on from its last stretch, window by window.
                tail = np.flatnonzero(stretch[cut:] != stretch[-1])
                if len(tail):
                    # The last rows of the hot anchor before this one may be among these.
                    next_hot, cut = int(anchor[-1]), cut + int(tail[-1]) + 1
                    yield from settled([x[:cut] for x in rows], [*hot, next_hot])
                    hot, carry = [next_hot], [x[cut:] for x in rows]
                    continue
            if cut:
                yield from settled([x[:cut] for x in rows], hot)
            carry = [x[cut:] for x in rows]
        if carry is not None:
            yield from settled(carry, hot)
    return settle


class _Singles:
    """Single windows of hot anchors: hashes, place and copies; folded in the task before they are dealt out."""

    def __init__(self):
        self._parts: list[tuple[np.ndarray, ...]] = []
        self._held = 0

    def add(self, key: int, places: np.ndarray, shard: np.ndarray, mark: np.ndarray, copies: int) -> None:
        self._parts.append((shard, mark, np.full(len(places), key, np.int64), places, np.full(len(places), copies, np.int64)))
        self._held += len(places)

    def full(self) -> bool:
        return self._held >= FOLD_ROWS

    def folded(self) -> Iterator[pa.RecordBatch]:
        """One row per window with its first place here and all its copies; the other places as settled runs."""
        if not self._held:
            return
        shard, mark, key, place, copies = (np.concatenate(x) for x in zip(*self._parts))
        self._parts, self._held = [], 0
        order = np.lexsort((place, key, mark, shard))
        shard, mark, key, place, copies = (x[order] for x in (shard, mark, key, place, copies))
        head = np.append(True, (shard[1:] != shard[:-1]) | (mark[1:] != mark[:-1]))
        at = np.flatnonzero(head)
        yield from _window_rows(shard[at], mark[at], key[at], place[at], np.ones(len(at), np.int64), np.add.reduceat(copies, at))
        # A place that is not the first here repeats it for certain; it is dealt by document, as in `_folded`.
        key, place = key[~head], place[~head]
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
        start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (place[1:] != place[:-1] + 1))) if len(key) else np.zeros(0, np.int64)
        key, runs, zero = key[start], np.diff(np.append(start, len(place))), np.zeros(len(start), np.int64)
        yield from _window_rows(key * np.int64(_BY_DOCUMENT), zero, key, place[start], runs, zero)


def _window_rows(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), _BATCH):
        own = [pa.array(c[at:at + _BATCH].astype(f.type.to_pandas_dtype())) for c, f in zip(columns, _PIECE)]
        yield pa.RecordBatch.from_arrays([*own, pa.nulls(len(own[0]), pa.binary())], schema=_PIECE)


def _fetch(spec: Windows):
    """Input: key, id, text, and the list of (anchor, first, windows, copies, verdict) asked of this document.

    Stretches come with their units. Single windows come without: like stretches they are told apart by two hashes.
    """
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles = _Singles()
        for batch in batches:
            out, size = [], 0
            for key, text, asked in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                if not asked:
                    continue
                units = spec.units(text.as_py() or b"")
                rolling: list[Rolling] = []
                for ask in asked:
                    first, n = ask["first"], ask["windows"]
                    if ask["verdict"] == STRETCH:
                        out.append((ask["anchor"], None, key, first, n, ask["copies"], units.piece(first, first + n + spec.window - 1)))
                        size += len(out[-1][-1])
                    else:
                        rolling = rolling or [Rolling(m, base) for m, base in zip(units.marks, BASES)]
                        places = np.arange(first, first + n)
                        mark, shard = (_signed(r.runs(places, places + spec.window)) for r in rolling)
                        singles.add(key, places, shard, mark, ask["copies"])
                        if singles.full():
                            yield from singles.folded()
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECE)], schema=_PIECE)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECE)], schema=_PIECE)
        yield from singles.folded()
    return fetch


def _merged(spare_first: bool, rows: list[np.ndarray], last: list[np.ndarray] | None, end: bool) -> tuple[Iterator[pa.RecordBatch], list[np.ndarray]]:
    """Repeats among rows of single windows, sorted by hashes and place; and the last row, whose next one is not known yet.

    `last` is what the call before gave: the columns of its last row, and whether the row before that was the same window.
    """
    shard, mark, key, first, copies = rows if last is None else (np.concatenate(x) for x in zip(last[:5], rows))
    same = np.append(last is not None and last[5][0], (shard[1:] == shard[:-1]) & (mark[1:] == mark[:-1]))
    repeated = same if spare_first else same | np.append(same[1:], False) | (copies > 1)
    if not end:
        repeated = repeated[:-1]
    on = np.flatnonzero(repeated)
    return _batches(_REPEAT, [key[on], first[on], np.ones(len(on), np.int64)]), [x[-1:] for x in (shard, mark, key, first, copies, same)]


def _compare(spec: Windows, compare: Compare, shard_bytes: int):
    """Over rows sorted by shard, mark, key and place.

    Pieces: whole shards are gathered up to `shard_bytes` and compared together. Single windows are a stream, of which
    one row is held, however many rows a window has.
    """
    def answer(held: list[Piece]) -> Iterator[pa.RecordBatch]:
        keys, firsts, sizes = [], [], []
        for piece, repeated in zip(held, compare(held)):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], repeated.astype(np.int8), [0]))))
            for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
                keys.append(piece.key)
                firsts.append(piece.first + a)
                sizes.append(b - a)
        yield from _batches(_REPEAT, [np.array(keys, np.int64), np.array(firsts, np.int64), np.array(sizes, np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Piece] = []
        size, shard = 0, None
        last: list[np.ndarray] | None = None
        for batch in batches:
            whole = batch.column(6).is_null()
            settled = pc.and_(whole, pc.equal(batch.column(5), 0))
            done = batch.filter(settled)
            yield from _batches(_REPEAT, [done.column(k).to_numpy() for k in (2, 3, 4)])
            singles = batch.filter(pc.and_not(whole, settled))
            if singles.num_rows:
                found, last = _merged(spec.spare_first, [singles.column(k).to_numpy() for k in (0, 1, 2, 3, 5)], last, False)
                yield from found
            pieces = batch.filter(pc.invert(whole))
            for own, _, key, first, windows, copies, data in zip(*(c.to_pylist() for c in pieces.columns)):
                if own != shard and size >= shard_bytes:
                    yield from answer(held)
                    held, size = [], 0
                shard = own
                held.append(Piece(data, key, first, windows, copies))
                size += len(data)
        if held:
            yield from answer(held)
        if last is not None:
            yield from _merged(spec.spare_first, [x[:0] for x in last[:5]], last, True)[0]
    return run


def repeated_windows(rows: DataFrame, id_col: str, text_col: str, spec: Windows, compare: Compare, shard_bytes: int) -> DataFrame:
    """`_row`, id, text (binary) and `_repeats`, the array of (first window, number of windows) that are repeated.

    `rows` comes from `keyed`. Each window stands in at most one entry. Documents without repeats have a null array.
    """
    texts = rows.select(KEY, id_col, F.col(text_col).cast("binary").alias(text_col))
    found = texts.select(KEY, text_col).mapInArrow(_scan(spec), _ANCHOR_SQL)
    dealt = found.repartition("anchor").sortWithinPartitions("anchor", "stretch", KEY, "first")
    verdicts = written(dealt.mapInArrow(_settle(spec), _VERDICT_SQL), "verdicts")
    asked = verdicts.filter(F.col("verdict") != WHOLE).groupBy(KEY).agg(
        F.collect_list(F.struct("anchor", "first", "windows", "copies", "verdict")).alias("_asked"))
    pieces = texts.join(asked, KEY, "left").mapInArrow(_fetch(spec), _PIECE_SQL)
    repeats = pieces.repartition("shard").sortWithinPartitions("shard", "mark", KEY, "first").mapInArrow(_compare(spec, compare, shard_bytes), _REPEAT_SQL)
    repeats = repeats.unionByName(verdicts.filter(F.col("verdict") == WHOLE).select(KEY, "first", "windows"))
    listed = repeats.groupBy(KEY).agg(F.collect_list(F.struct("first", "windows")).alias("_repeats"))
    return texts.join(listed, KEY, "left")


def covered(repeats: Sequence[dict] | None, window: int, units: int) -> np.ndarray:
    """Of a document's units, those inside a repeated window."""
    if not repeats:
        return np.zeros(units, bool)
    step = np.zeros(units + 1, np.int64)
    for x in repeats:
        step[x["first"]] += 1
        step[x["first"] + x["windows"] + window - 1] -= 1
    return np.cumsum(step)[:units] > 0
