"""Suffix-array dedup over bytes: strings that also start earlier are taken out, by external induced sorting.

Repeated windows are narrowed down by anchors (`repeats`). The stretches that need their bytes compared arrive in
shards; the suffixes of a shard are sorted by induction with queues that move to disk (`suffixes`), and suffixes that
share a window with their neighbour form a group, of which all but the earliest go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import keyed
from tallyhouse.llm.repeats import HOT_STRETCHES, Bytes, Piece, Windows, covered, repeated_windows
from tallyhouse.llm.suffixes import QUEUE_BYTES, sorted_suffixes

WINDOW = 100
GRAM = 32
# Small enough for a processor's cache; larger ones are right, too.
SHARD_BYTES = 1 << 20


def later(pieces: Sequence[Piece], window: int, queue_bytes: int = QUEUE_BYTES) -> list[np.ndarray]:
    """For each piece, which of its windows also start in a smaller document or earlier in the same one."""
    if not pieces:
        return []
    sizes = np.array([len(p.data) + 1 for p in pieces])
    text = np.ones(int(sizes.sum()), np.int32)  # 1 divides pieces, 0 ends the last one
    text[-1] = 0
    starts = np.cumsum(sizes) - sizes
    for piece, at in zip(pieces, starts.tolist()):
        text[at:at + len(piece.data)] = np.frombuffer(piece.data, np.uint8).astype(np.int32) + 2
    windows = np.array([p.windows for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), windows)
    offset = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    place = starts[owner] + offset
    keys, firsts = np.array([p.key for p in pieces]), np.array([p.first for p in pieces])
    age = np.full(len(text), len(text), np.int64)
    age[place[np.lexsort((firsts[owner] + offset, keys[owner]))]] = np.arange(len(place))
    order, common = sorted_suffixes(text, window, queue_bytes)
    head = np.flatnonzero(common < window)
    oldest = np.repeat(np.minimum.reduceat(age[order], head), np.diff(np.append(head, len(order))))
    repeated = np.zeros(len(text), bool)
    repeated[order] = age[order] > oldest
    flags = repeated[place]
    return np.split(flags, np.cumsum(windows)[:-1])


_REPORT = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def repeated_bytes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot: int = HOT_STRETCHES,
                   shard_bytes: int = SHARD_BYTES, queue_bytes: int = QUEUE_BYTES) -> DataFrame:
    """Per row of `documents`: id, text and the windows of `window` bytes that also start earlier."""
    rows, _ = keyed(documents, id_col, text_col)
    spec = Windows(Bytes, window, min(GRAM, window), spare_first=True, hot=hot)
    return repeated_windows(rows, id_col, text_col, spec, lambda pieces: later(pieces, window, queue_bytes), shard_bytes)


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """Per document: bytes, bytes removed, runs removed, digest of the bytes kept.

    A byte goes if a string of `window` bytes around it also starts in a document of smaller id, or earlier in the
    same one. Null text: as empty, nothing to remove. Null and repeated ids: each row is a document, ordered by id (null
    first) and text, so of repeated rows the first stays. Texts shorter than a window stay. Other columns are not read.
    """
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, repeats in zip(batch.column(1), batch.column(2).to_pylist()):
                data = text.as_py() or b""
                if not repeats:
                    out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    continue
                gone = covered(repeats, window, len(data))
                left = np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
                out.append((len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _REPORT)] if out else [pa.array([], f.type) for f in _REPORT]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *_REPORT.names])

    found = repeated_bytes(documents, id_col, text_col, window, **options).select(F.col(id_col), text_col, "_repeats")
    schema = T.StructType([found.schema[0], *T._parse_datatype_string("n_bytes long, n_removed long, n_spans long, kept_sha256 string").fields])
    return found.mapInArrow(kept, schema)
