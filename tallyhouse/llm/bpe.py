"""Byte-level BPE: encoding of whole texts with a local rank file, and decoding back to raw bytes."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import record, slices

# Texts are cut into pieces of about so many characters, so that the encoder's working memory stays small.
PIECE_CHARS = 100_000
_BATCH_BYTES = 8 << 20
# A space between two characters that are no white space: the pattern never joins what stands before it to it, and
# the piece before it ends in a character whose match looks at nothing behind it.
_SAFE = re.compile(r"(?<=\S)(?= \S)")

_DIGESTS = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def read_ranks(path: str) -> bytes:
    """The rank file: a base64 token and its rank on each line; bounded by the vocabulary, so it can be broadcast."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def _coder(ranks: bytes, pattern: str) -> Coder:
    return Coder(ranks, pattern)


class Coder:
    """Encoder and decoder for one rank file, without special tokens."""

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._bytes = {rank: token for token, rank in table.items()}

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE_CHARS:
            return self._encoding.encode_ordinary(text)
        ids: list[int] = []
        for piece in pieces(text):
            ids += self._encoding.encode_ordinary(piece)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """Raw bytes; a sequence cut inside a character gives a part of it, not a replacement sign."""
        return b"".join(map(self._bytes.__getitem__, ids))


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of at least `size` characters that end at safe boundaries; without any, in one piece."""
    at = 0
    while len(text) - at > size and (found := _SAFE.search(text, at + size)):
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def _ranks(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(read_ranks(path))


def digests(documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of tokens, digest of the ids, digest of the bytes they decode to.

    Null text: as empty, no tokens. Each row, also a repeated one, is encoded by itself; nothing is shuffled. Strings
    that look like special tokens are ordinary text. Other columns are not read.
    """
    ranks = _ranks(documents.sparkSession, path)
    rows = documents.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks.value, pattern)
        for batch in slices(batches, 1, _BATCH_BYTES):
            out = []
            for text in batch.column(1).to_pylist():
                ids = coder.encode(text)
                out.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()))
            coded = record(_DIGESTS, list(zip(*out)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *coded.columns], names=[id_col, *_DIGESTS.names])

    schema = T.StructType([rows.schema[0], *T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string").fields])
    return rows.mapInArrow(code, schema)


def encode(documents: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """`documents` with an array of token ids in `ids_col`, which is replaced if there is one; null text: no tokens."""
    ranks = _ranks(documents.sparkSession, path)
    rows = documents.drop(ids_col)
    place, names = rows.columns.index(text_col), [*rows.columns, ids_col]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks.value, pattern)
        for batch in slices(batches, place, _BATCH_BYTES):
            ids = pa.array([coder.encode(text or "") for text in batch.column(place).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=names)

    return rows.mapInArrow(code, T.StructType([*rows.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """`encoded` with the raw bytes of its ids in `bytes_col`; null ids: null. An id without a token is an error."""
    ranks = _ranks(encoded.sparkSession, path)
    rows = encoded.drop(bytes_col)
    place, names = rows.columns.index(ids_col), [*rows.columns, bytes_col]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks.value, pattern)
        for batch in batches:
            raw = pa.array([None if ids is None else coder.decode(ids) for ids in batch.column(place).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], names=names)

    return rows.mapInArrow(code, T.StructType([*rows.schema.fields, T.StructField(bytes_col, T.BinaryType())]))
