"""Benchmark decontamination: a generalised suffix automaton of the test items, streamed over by the documents.

The automaton holds every run of words of every item. A document is read word by word; the automaton's state is the
longest run that ends at the current word and occurs in an item. When that run is at least a window long, the last
`window` words are a window of some item, and the state says of which. An item shorter than a window counts as one
window of its own length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.automaton import SuffixAutomaton
from tallyhouse.llm.common import free_name, slices, written

WINDOW = 10
# An automaton takes about a kilobyte per item word in a Python worker. More words than this are split over several
# automata, and documents pass them one after the other.
SHARD_WORDS = 200_000
MAX_COVERAGE = 0.5
# Bytes of text cut at once.
_TEXT_BYTES = 4 << 20

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
# Letters A-Z become small, other ASCII but digits and letters becomes a space; bytes of longer characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def fold_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton(SuffixAutomaton):
    """Suffix automaton of test items, with what stands at its states."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]], window: int):
        super().__init__()
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        runs = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in fold_words(text)]) for name, text in items]
        runs = [(name, run) for name, run in runs if run]
        for _, run in runs:
            self.add(run)
        self.shortest = min((min(len(run), window) for _, run in runs), default=window)
        # Per state: items that hold the window that ends here; and (length, item) of short items that end here.
        found: list[set[str | None]] = [set() for _ in self.length]
        ends: list[set[tuple[int, str | None]]] = [set() for _ in self.length]
        for name, run in runs:
            state = 0
            for i, word in enumerate(run, 1):
                state = self.steps[state][word]
                if i >= window:
                    found[self.cut(state, window)].add(name)
            if len(run) < window:
                ends[state].add((len(run), name))
        # A short item also ends wherever a longer run ends with it: hand it up from the links.
        for state in self.by_length():
            ends[state] |= ends[self.link[state]]
        self.windows = [tuple(x) for x in found]
        self.shorts = [tuple(x) for x in ends]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint spans (first word, word after the last) covered by windows, in order; and the items they are of."""
        number = self.vocabulary.get
        known = np.fromiter((number(w, -1) for w in words), np.int64, len(words))
        # Runs of words that occur in items at all; only these can hold a window.
        edge = np.flatnonzero(np.diff(np.concatenate(([0], known >= 0, [0]))))
        first, last = edge[0::2], edge[1::2]
        long = last - first >= self.shortest
        spans: list[tuple[int, int]] = []
        items: set = set()
        steps, link, length, window = self.steps, self.link, self.length, self.window
        for a, b in zip(first[long].tolist(), last[long].tolist()):
            state = size = 0
            for i, word in enumerate(known[a:b].tolist(), a + 1):
                while state and word not in steps[state]:
                    state = link[state]
                    size = length[state]
                state = steps[state].get(word, 0)
                size = size + 1 if state else 0
                start = i
                if size >= window:
                    items.update(self.windows[self.cut(state, window)])
                    start = i - window
                for n, item in self.shorts[state]:
                    if n <= size:
                        items.add(item)
                        start = min(start, i - n)
                if start < i:
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i))
        return spans, items


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_spans(text: bytes, spans: Sequence[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them; one space where words met."""
    if not spans:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join(parts) + text[at:]


def automata(items: DataFrame, item_col: str, text_col: str, window: int, shard_words: int = SHARD_WORDS) -> Iterator[Broadcast]:
    """Automata of all items, each of at most `shard_words` words or of one item, built one at a time."""
    context = items.sparkSession.sparkContext
    held, size = [], 0
    rows = items.select(F.col(item_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")).cast("binary")).toLocalIterator()
    for name, text in rows:
        n = len(fold_words(bytes(text)))
        if held and size + n > shard_words:
            yield context.broadcast(Automaton(held, window))
            held, size = [], 0
        held.append((name, bytes(text)))
        size += n
    yield context.broadcast(Automaton(held, window))


FOUND = ("_n_words", "_spans", "_items")
_FOUND_AS = ("long", "array<int>", "array<string>")


def hits(documents: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
         window: int = WINDOW, shard_words: int = SHARD_WORDS, names: Sequence[str] = FOUND) -> DataFrame:
    """`documents` with three more columns, named by `names`: words, word spans (flattened first/after-last pairs), items.

    Null and empty texts have no words and no hits. Items without words match nothing; an item without an id is looked
    for but cannot be named. Repeated items count once by id; each document row, also a repeated one, is looked at by
    itself. Columns of these three names are replaced. Items beyond one automaton take one pass over the documents each.
    """
    return _hits(documents, items, text_col, item_col, item_text_col, window, shard_words, names)


# What a pass does with its own rows before they leave the worker, and the columns that come out.
Then = tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], T.StructType]


def _hits(documents: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          window: int = WINDOW, shard_words: int = SHARD_WORDS, names: Sequence[str] = FOUND, then: Then | None = None) -> DataFrame:
    """`hits`, with `then` done in the last pass: a task with two Python steps in a row holds two workers, and both stay."""
    rows, last = documents.drop(*names), None
    for shard in automata(items, item_col, item_text_col, window, shard_words):
        if last is not None:  # one automaton at a time, on the driver and in a worker
            rows = written(_pass(rows, text_col, last, tuple(names)), "decontaminate")
            last.unpersist()
        last = shard
    return _pass(rows, text_col, last, tuple(names), then)


def _pass(rows: DataFrame, text_col: str, shard: Broadcast, names: tuple[str, ...], then: Then | None = None) -> DataFrame:
    again = names[1] in rows.columns
    kept = [c for c in rows.columns if c not in names]
    place = kept.index(text_col)
    found_as = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in zip(names, _FOUND_AS)]
    schema = T.StructType([*rows.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, *found_as])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shard.value
        for batch in batches:
            counts, spans, listed = [], [], []
            before = [batch.column(i).to_pylist() for i in range(len(kept) + 1, len(kept) + 3)] if again else None
            for i, text in enumerate(batch.column(place).cast(pa.binary())):
                words = fold_words(text.as_py() or b"")
                found, items = automaton.scan(words)
                items.discard(None)
                if again:
                    old = before[0][i]
                    found, items = merged([*found, *zip(old[0::2], old[1::2])]), items | set(before[1][i])
                counts.append(len(words))
                spans.append([x for span in found for x in span])
                listed.append(sorted(items))
            columns = [*batch.columns[:len(kept)], pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(listed, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    order = [*kept, *names] if again else kept
    given = rows.select(*[F.col(f"`{c}`") for c in order])
    if then is None:
        return given.mapInArrow(scan, schema)
    further, schema = then
    return given.mapInArrow(lambda batches: further(scan(batches)), schema)


def report(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: words, words hit, items found and their digest. See `hits` for odd rows."""
    text_col = options.get("text_col", "text")
    found = hits(documents.select(F.col(id_col), F.col(text_col)), items, **options)
    covered = F.expr("aggregate(_spans, struct(0 AS sign, 0L AS total), (a, x) -> struct(1 - a.sign AS sign, "
                     "a.total + IF(a.sign = 0, -x, x) AS total)).total")
    rows = found.select(F.col(id_col), F.col("_n_words").alias("n_words"), covered.alias("n_hit"), "_items")
    return rows.select(id_col, "n_words", "n_hit", F.size("_items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(documents: DataFrame, items: DataFrame, text_col: str = "text", max_coverage: float = MAX_COVERAGE, **options) -> DataFrame:
    """Documents without the spans that occur in items; those covered beyond `max_coverage` are dropped whole.

    Rows without a hit come back as they are, null texts too. Columns and their order stay.
    """
    place, width, names = documents.columns.index(text_col), len(documents.columns), documents.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place, _TEXT_BYTES):
            texts, keep = [], []
            for text, n, flat in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column(width).to_pylist(), batch.column(width + 1).to_pylist()):
                spans = list(zip(flat[0::2], flat[1::2]))
                keep.append(sum(b - a for a, b in spans) <= max_coverage * n)
                texts.append(text if text is None else cut_spans(text, spans))
            columns = list(batch.columns[:width])
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    free = [free_name(name, documents.columns) for name in FOUND]
    return _hits(documents, items, text_col=text_col, names=free, then=(cut, documents.schema), **options)
