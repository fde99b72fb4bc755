"""Substring dedup over words: passages that occur more than once are taken out, by suffix automata of shards.

Repeated windows are narrowed down by anchors (`repeats`). What needs a comparison of words arrives in shards; a
shard's stretches are the reference of one suffix automaton, whose states count their occurrences, and the stretches
are streamed through it: the matching statistics say at each word how long the longest match is and in how many
places it stands. A shard holds few stretches of an anchor, so an automaton has a bounded size and goes to the one task
that needs it, with the shuffle that brings its stretches, instead of to every task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.llm.automaton import SuffixAutomaton
from tallyhouse.llm.common import keyed
from tallyhouse.llm.repeats import HOT_STRETCHES, Piece, Windows, Words, covered, repeated_windows

WINDOW = 35
GRAM = 8
SHARD_BYTES = 256 * 1024


def matches(pieces: Sequence[Piece], window: int) -> list[np.ndarray]:
    """For each piece, which of its windows occur at least twice in all of them, copies counted."""
    numbers: dict[bytes, int] = {}
    automaton = SuffixAutomaton()
    runs = [[numbers.setdefault(w, len(numbers)) for w in p.data.split()] for p in pieces]
    ends: list[tuple[int, int]] = []
    for piece, run in zip(pieces, runs):
        ends += [(state, min(piece.copies, 2)) for state in automaton.add(run)[window - 1:]]
    seen = [0] * len(automaton.length)
    # A state may have been split since it was noted; its runs of this length still end there.
    for state, copies in ends:
        seen[state] += copies
    for state in reversed(automaton.by_length()):
        seen[automaton.link[state]] += seen[state]
    out = []
    for run in runs:
        state, repeated = 0, []
        for i, word in enumerate(run, 1):
            state = automaton.steps[state][word]
            if i >= window:
                repeated.append(seen[automaton.cut(state, window)] > 1)
        out.append(np.array(repeated, bool))
    return out


def repeated_words(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot: int = HOT_STRETCHES) -> DataFrame:
    """Per row of `documents`: id, text and the windows of `window` words that occur anywhere else."""
    rows, _ = keyed(documents, id_col, text_col)
    spec = Windows(Words, window, min(GRAM, window), spare_first=False, hot=hot)
    return repeated_windows(rows, id_col, text_col, spec, lambda pieces: matches(pieces, window), SHARD_BYTES)


_REPORT = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot: int = HOT_STRETCHES) -> DataFrame:
    """Per document: words, words removed, digest of the words kept.

    A word goes if a window of `window` words around it also starts anywhere else, in the same document, too. Null and
    empty texts have no words; texts shorter than a window lose nothing. Null and repeated ids: each row is a document,
    so a row that is repeated repeats its windows. Other columns are not read.
    """
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, repeats in zip(batch.column(1), batch.column(2).to_pylist()):
                words = (text.as_py() or b"").split()
                gone = covered(repeats, window, len(words))
                left = [w for w, g in zip(words, gone.tolist()) if not g] if repeats else words
                out.append((len(words), int(gone.sum()), hashlib.sha256(b" ".join(left)).hexdigest()))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _REPORT)] if out else [pa.array([], f.type) for f in _REPORT]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *_REPORT.names])

    found = repeated_words(documents, id_col, text_col, window, hot).select(id_col, text_col, "_repeats")
    schema = T.StructType([found.schema[0], *T._parse_datatype_string("n_words long, n_removed long, kept_sha256 string").fields])
    return found.mapInArrow(kept, schema)
