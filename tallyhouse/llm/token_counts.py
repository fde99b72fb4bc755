"""Token counts by a tokenizer that is compiled to a finite-state transducer.

A piece vocabulary merges neighbours in order of their scores. Which tokens the merges leave of a text can be told from
left to right: a sequence of tokens is what they leave if that holds for every two neighbours alone, so exactly one
token that ends at a character fits the last token of the text before it. Hence a state is enough that holds, for every
suffix of the text that some piece starts with, the last token before that suffix and its count of tokens. The
transducer is deterministic; a transition reads a character and is annotated with the change of the count. States and
transitions are made when a text first needs them.

A pair of characters that stands in no piece ends every merge, so behind it the state is the same whatever came before.
That makes the state map of a chunk, from the state before it to the state and count behind it, short: the characters
before its first such pair, and one count and one state for what follows. Maps compose, in any grouping, so chunks of
long texts are mapped in parallel, and a prefix scan over their maps gives the count at every chunk's end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import KEY, keyed, record, slices

_SPACE = "▁"
# Texts of more characters are cut into chunks, which other tasks may map.
LONG_CHARS = 1_000_000
CHUNK_CHARS = 65_536
# Chunks whose maps are composed in one group.
SPAN = 256
# Transitions that are kept; a task that needs more starts over with none.
KEPT_TRANSITIONS = 1_500_000
_BATCH_BYTES = 8 << 20


class State(dict):
    """A state: transitions by character, and what it stands for.

    `suffix` is the longest suffix of the text that starts a piece. `before` holds, for it and each shorter suffix that
    starts a piece, down to the empty one, the last token before that suffix, as far as it can bar a token from
    following, and the number of tokens before it, as a difference from that of the whole text.
    """

    __slots__ = ("machine", "suffix", "before")

    def __init__(self, machine: Transducer, suffix: str, before: tuple):
        super().__init__()
        self.machine, self.suffix, self.before = machine, suffix, before

    def __missing__(self, char: str) -> tuple[State, int]:
        return self.machine.extend(self, char)

    def text(self) -> str:
        """The state as text, which any other task can read."""
        return json.dumps([self.suffix, self.before])


class StateMap(NamedTuple):
    """What a chunk does to any state: it reads `head`, then adds `count` and goes to `state`.

    Without a state, `head` is the whole chunk.
    """

    head: str
    count: int
    state: State | None


_START = ("", ((None, 0),))


class Transducer:
    """Token counts for pieces and their scores; of characters that are no piece, every byte is a token."""

    def __init__(self, scores: dict[str, float], kept: int = KEPT_TRANSITIONS):
        self._scores, self._kept_most = scores, kept
        self._proper = {p[:k] for p in scores for k in range(1, len(p))}
        self._starts = self._proper | scores.keys()
        self._pairs = {p[k:k + 2] for p in scores for k in range(len(p) - 1)}
        self._forget()

    @classmethod
    def of_model(cls, model: bytes) -> Transducer:
        coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = [i for i in range(coder.get_piece_size()) if not (
            coder.is_unknown(i) or coder.is_control(i) or coder.is_byte(i) or coder.is_unused(i))]
        return cls({coder.id_to_piece(i): coder.get_score(i) for i in ids})

    def _forget(self) -> None:
        self._states: dict[tuple, State] = {}
        self._transitions = 0
        self._spines: dict[str, tuple[str, ...]] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._bars: dict[tuple[str, str], str | None] = {}
        self._suffixes: dict[str, list[str]] = {}
        self.start = self.state(*_START)

    def state(self, suffix: str, before: tuple) -> State:
        key = (suffix, before)
        found = self._states.get(key)
        if found is None:
            found = self._states[key] = State(self, suffix, before)
        return found

    def read(self, text: str) -> State:
        """The state that `State.text` gave."""
        suffix, before = json.loads(text)
        return self.state(suffix, tuple((token, count) for token, count in before))

    # ---- merges of short texts, which say what fits ----

    def merged(self, text: str) -> list[tuple]:
        """The trees that the merges leave: (text, left, right), or (character,)."""
        trees: list[tuple] = [(char,) for char in text]
        while True:
            best, place = None, -1
            for k in range(len(trees) - 1):
                score = self._scores.get(trees[k][0] + trees[k + 1][0])
                if score is not None and (best is None or score > best):
                    best, place = score, k
            if best is None:
                return trees
            left, right = trees[place:place + 2]
            trees[place:place + 2] = [(left[0] + right[0], left, right)]

    def _spine(self, piece: str) -> tuple[str, ...]:
        """The piece and the parts that its merges leave at its right end, longest first; none if no merges make it."""
        spine = self._spines.get(piece)
        if spine is None:
            spine = ()
            if piece in self._scores and len(trees := self.merged(piece)) == 1:
                tree, parts = trees[0], []
                while len(tree) > 1:
                    parts.append(tree[0])
                    tree = tree[2]
                spine = (*parts, tree[0])
            self._spines[piece] = spine
        return spine

    def _fit(self, token: str, following: str) -> bool:
        """Whether the merges leave these two tokens of the text they make."""
        fits = self._fits.get((token, following))
        if fits is None:
            fits = self._fits[token, following] = [tree[0] for tree in self.merged(token + following)] == [token, following]
        return fits

    def _bar(self, token: str, suffix: str) -> str | None:
        """As much of `token`'s right end as can bar tokens that start with `suffix`, or that it starts with; or none.

        A part of the right end matters if it makes a piece with the start of what follows. What lies left of the merge
        that uses up the longest such part does not.
        """
        if (token, suffix) in self._bars:
            return self._bars[token, suffix]
        above, bar = token, None
        for part in self._spine(token):
            ends = (part + suffix[:k] for k in range(1, len(suffix) + 1))
            if part + suffix in self._proper or any(end in self._scores for end in ends):
                bar = above
                break
            above = part
        self._bars[token, suffix] = bar
        return bar

    def _live(self, suffix: str) -> list[str]:
        """The suffix, and each shorter one that starts a piece, down to the empty one."""
        live = self._suffixes.get(suffix)
        if live is None:
            live = self._suffixes[suffix] = [*(s for k in range(len(suffix)) if (s := suffix[k:]) in self._starts), ""]
        return live

    def extend(self, state: State, char: str) -> tuple[State, int]:
        """The transition from `state` by `char`, which is kept there."""
        if char not in self._scores:
            step = (self.start, len(char.encode("utf-8", "replace")))
        else:
            token, count, longer = "", 0, []
            for suffix, (last, before) in zip(self._live(state.suffix), state.before):
                longer.append((suffix + char, last, before))
                if self._spine(suffix + char) and (last is None or self._fit(last, suffix + char)):
                    token, count = suffix + char, before + 1
            kept = [(s, None if last is None else self._bar(last, s), before - count) for s, last, before in longer if s in self._starts]
            ends = [*((last, before) for _, last, before in kept), (self._bar(token, ""), 0)]
            step = (self.state(kept[0][0] if kept else "", tuple(ends)), count)
        self._transitions += 1
        state[char] = step
        return step

    # ---- texts and chunks ----

    def run(self, state: State, text: str) -> tuple[State, int]:
        """State and number of tokens that `text` adds."""
        total = 0
        for char in text:
            state, count = state[char]
            total += count
        return state, total

    def _bounded(self) -> None:
        """States that others still hold go on working; they are made anew for texts to come."""
        if self._transitions > self._kept_most:
            self._forget()

    def count(self, text: str) -> int:
        """Number of tokens of a whole text."""
        self._bounded()
        return self.run(self.start, spaced(text))[1]

    def map_of(self, chunk: str, previous: str) -> StateMap:
        """The state map of a chunk behind the character `previous`; a text starts behind an empty one."""
        self._bounded()
        at, pairs, scores = 0, self._pairs, self._scores
        if previous:
            for at, char in enumerate(chunk):
                if previous + char not in pairs or char not in scores:
                    break
                previous = char
            else:
                return StateMap(chunk, 0, None)
        state, count = self.run(self.start, chunk[at:])
        return StateMap(chunk[:at], count, state)

    def compose(self, first: StateMap, then: StateMap) -> StateMap:
        """The map of two neighbouring chunks; any grouping gives the same."""
        if first.state is None:
            return StateMap(first.head + then.head, then.count, then.state)
        state, count = self.run(first.state, then.head)
        return StateMap(first.head, first.count + count + then.count, state if then.state is None else then.state)

    def scan(self, maps: Sequence[StateMap]) -> list[StateMap]:
        """The composition of the first one, two, three, ... maps: each round doubles the reach of every place."""
        out, reach = list(maps), 1
        while reach < len(out):
            out = [self.compose(out[k - reach], out[k]) if k >= reach else out[k] for k in range(len(out))]
            reach *= 2
        return out


def spaced(text: str) -> str:
    """The text as the pieces spell it: a mark for each space, and one before the text."""
    return _SPACE + text.replace(" ", _SPACE) if text else ""


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[tuple[int, str, str]]:
    """Number, character before, and characters of each chunk of a text that was spaced."""
    for number, at in enumerate(range(0, len(text), size)):
        yield number, text[at - 1:at] if at else "", text[at:at + size]


@lru_cache(maxsize=1)
def _transducer(model: bytes) -> Transducer:
    return Transducer.of_model(model)


def _machine(spark, path: str) -> Broadcast:
    """The model file, bounded by its vocabulary."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


_MAP = [("_head", "string"), ("_count", "bigint"), ("_state", "string")]
_ARROW = {"string": pa.string(), "bigint": pa.int64()}


def _fields(*columns: tuple[str, str]) -> tuple[T.StructType, pa.Schema]:
    return (T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in columns]),
            pa.schema([(name, _ARROW[kind]) for name, kind in columns]))


def _read_map(machine: Transducer, head: str, count: int, state: str | None) -> StateMap:
    return StateMap(head, count, None if state is None else machine.read(state))


def _written_map(one: StateMap) -> tuple[str, int, str | None]:
    return one.head, one.count, None if one.state is None else one.state.text()


def chunk_maps(texts: DataFrame, model: Broadcast, key: str, text: str, size: int = CHUNK_CHARS) -> DataFrame:
    """The state map of every chunk of every text: `key`, `_chunk`, and the map. Chunks are dealt over tasks."""
    cut_as, cut_arrow = _fields((key, "bigint"), ("_chunk", "bigint"), ("_previous", "string"), ("_text", "string"))
    map_as, map_arrow = _fields((key, "bigint"), ("_chunk", "bigint"), *_MAP)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for piece in chunks(spaced(whole or ""), size):
                    rows.append((number, *piece))
                    if len(rows) == 64:
                        yield record(cut_arrow, list(zip(*rows)))
                        rows = []
                if rows:
                    yield record(cut_arrow, list(zip(*rows)))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(model.value)
        for batch in slices(batches, 3, _BATCH_BYTES):
            maps = [_written_map(machine.map_of(chunk, previous)) for previous, chunk in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield record(map_arrow, [batch.column(0), batch.column(1), *zip(*maps)])

    return texts.select(key, text).mapInArrow(cut, cut_as).repartition(key, "_chunk").mapInArrow(mapped, map_as)


def span_starts(maps: DataFrame, model: Broadcast, key: str, span: int = SPAN) -> DataFrame:
    """Per `span` chunks of a text: `key`, `_span`, state and tokens before them, and tokens behind them.

    Maps are composed by span, in parallel, and then scanned over the spans of a text.
    """
    total_as, total_arrow = _fields((key, "bigint"), ("_span", "bigint"), *_MAP)
    start_as, start_arrow = _fields((key, "bigint"), ("_span", "bigint"), ("_entry", "string"), ("_before", "bigint"), ("_after", "bigint"))

    def ordered(table: pa.Table, by: str, machine: Transducer) -> tuple[list[int], list[StateMap]]:
        rows = table.sort_by(by)
        return rows.column(by).to_pylist(), [_read_map(machine, *one) for one in zip(*(rows.column(n).to_pylist() for n, _ in _MAP))]

    def total(group: tuple, table: pa.Table) -> pa.Table:
        machine = _transducer(model.value)
        _, maps = ordered(table, "_chunk", machine)
        last = machine.scan(maps)[-1]
        return pa.Table.from_batches([record(total_arrow, [[v] for v in (group[0].as_py(), group[1].as_py(), *_written_map(last))])])

    def starts(group: tuple, table: pa.Table) -> pa.Table:
        machine = _transducer(model.value)
        spans, maps = ordered(table, "_span", machine)
        done = machine.scan(maps)
        # A text starts in the start state, so its first chunk leaves no head, and neither does a prefix.
        entries = [machine.start, *(one.state for one in done[:-1])]
        counts = [0, *(one.count for one in done)]
        rows = [(group[0].as_py(), span, entry.text(), counts[k], counts[k + 1]) for k, (span, entry) in enumerate(zip(spans, entries))]
        return pa.Table.from_batches([record(start_arrow, list(zip(*rows)))])

    spans = maps.withColumn("_span", F.floor(F.col("_chunk") / span).cast("bigint"))
    return spans.groupBy(key, "_span").applyInArrow(total, total_as).groupBy(key).applyInArrow(starts, start_as)


def offsets(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK_CHARS, span: int = SPAN) -> DataFrame:
    """Per chunk of `size` characters of a text: tokens of the text up to the chunk's start and up to its end.

    Columns: the id, `chunk` (from 0), `tokens_before`, `tokens_after`. The mark that stands before a text counts as its
    first character. A text cut there may have a token across the cut; the counts are those of the text before it
    alone. Null and empty texts have no chunks. Rows with null or repeated ids are documents of their own.
    """
    model = _machine(documents.sparkSession, path)
    rows, _ = keyed(documents, id_col, text_col)
    maps = chunk_maps(rows, model, KEY, text_col, size)
    starts = span_starts(maps, model, KEY, span)
    out_as, out_arrow = _fields((KEY, "bigint"), ("chunk", "bigint"), ("tokens_before", "bigint"), ("tokens_after", "bigint"))

    def counted(group: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        machine = _transducer(model.value)
        state, count = machine.read(right.column("_entry")[0].as_py()), right.column("_before")[0].as_py()
        table, rows = left.sort_by("_chunk"), []
        for number, *one in zip(*(table.column(n).to_pylist() for n in ("_chunk", *(n for n, _ in _MAP)))):
            here = machine.compose(StateMap("", count, state), _read_map(machine, *one))
            rows.append((group[0].as_py(), number, count, here.count))
            state, count = here.state, here.count
        return pa.Table.from_batches([record(out_arrow, list(zip(*rows)))])

    spans = maps.withColumn("_span", F.floor(F.col("_chunk") / span).cast("bigint"))
    each = spans.groupBy(KEY, "_span").cogroup(starts.groupBy(KEY, "_span")).applyInArrow(counted, out_as)
    return rows.select(KEY, id_col).join(each, KEY).drop(KEY)


def counts(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, long_chars: int = LONG_CHARS,
           size: int = CHUNK_CHARS, span: int = SPAN) -> DataFrame:
    """Per row: `n_bytes`, `n_tokens`, and whether the text is `over_limit`.

    Counts are those of the piece model at `path` without begin and end; strings that look like its special tokens are
    ordinary text. Null text counts as empty: no bytes, no tokens. Rows with null or repeated ids are documents of their
    own. Texts of more than `long_chars` characters are cut into chunks that are mapped in parallel. Other columns are
    not read.
    """
    model = _machine(documents.sparkSession, path)
    rows, _ = keyed(documents, id_col, text_col)
    is_long = F.coalesce(F.char_length(text_col), F.lit(0)) > long_chars
    bytes_of = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes")
    short = rows.filter(~is_long).select(id_col, bytes_of, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    long = rows.filter(is_long)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(model.value)
        for batch in slices(batches, 2, _BATCH_BYTES):
            found = pa.array([machine.count(text) for text in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=[id_col, "n_bytes", "n_tokens"])

    schema = T.StructType([short.schema[0], *T._parse_datatype_string("n_bytes long, n_tokens long").fields])
    starts = span_starts(chunk_maps(long, model, KEY, text_col, size), model, KEY, span)
    totals = starts.groupBy(KEY).agg(F.max_by("_after", "_span").alias("n_tokens"))
    dealt = long.select(KEY, id_col, bytes_of).join(totals, KEY).select(id_col, "n_bytes", "n_tokens")
    return short.mapInArrow(count, schema).unionByName(dealt).withColumn("over_limit", F.col("n_tokens") > limit)
