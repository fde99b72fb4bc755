"""WARC archives: records written by tasks to the shared folder, and a sequential reader.

A record is one gzip member. The reader inflates a member piece by piece, frames the record by its Content-Length and
checks its digest; it never holds more than one record. Archives are written under a name of their own per attempt and
renamed when whole, so a repeated task leaves no half archive behind and no reader sees one.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import KEY, keyed, record
from tallyhouse.sources.scratch import scratch_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 * 1024 * 1024
_CHUNK = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ARCHIVE = pa.schema([("path", pa.string()), ("records", pa.int64()), ("archive_bytes", pa.int64())])
_RECORD = pa.schema([("record_key", pa.int64()), ("record_id", pa.string()), ("uri", pa.string()), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64())])
ARCHIVE_SCHEMA = "path string, records long, archive_bytes long"
RECORD_SCHEMA = ("record_key long, record_id string, uri string, payload binary, payload_bytes long, "
                 "payload_digest string, record_type string, refers_to long")


class WarcError(ValueError):
    """An archive that is cut off, badly framed or does not match its digests."""


def _plain(value: str | None) -> str:
    """A header value: no line breaks or other controls can get into the header block."""
    return "".join(c if c.isprintable() else "%" + c.encode("utf-8", "surrogatepass").hex() for c in (value or "")).strip()


def write_record(key: int, uri: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as one gzip member. A revisit holds no block: its payload is that of the record it refers to."""
    block = b"" if refers_to is not None else payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:record:{key}>", f"WARC-Target-URI: {_plain(uri)}",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
            f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:record:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _members(stream) -> Iterator[Iterator[bytes]]:
    """Of each gzip member its inflated pieces, at most `_CHUNK` bytes each."""
    rest = stream.read(_CHUNK)
    while rest:
        inflate, box = zlib.decompressobj(31), [rest]

        def pieces(inflate=inflate, box=box):
            while not inflate.eof:
                data = inflate.unconsumed_tail or box[0] or stream.read(_CHUNK)
                box[0] = b""
                out = inflate.decompress(data, _CHUNK)
                if not data and not out:
                    raise WarcError("archive ends inside a record")
                if out:
                    yield out
            box[0] = inflate.unused_data

        inner = pieces()
        yield inner
        for _ in inner:  # what the caller left unread
            pass
        rest = box[0] or stream.read(_CHUNK)


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record, in order; raises WarcError on a bad archive."""
    for pieces in _members(stream):
        buffer = bytearray()
        try:
            seen = 0
            while (end := buffer.find(b"\r\n\r\n", max(seen - 3, 0))) < 0:
                seen, piece = len(buffer), next(pieces, None)
                if piece is None:
                    raise WarcError("record without a header block")
                buffer += piece
            lines = bytes(buffer[:end]).decode("utf-8").split("\r\n")
            if not lines[0].startswith("WARC/1."):
                raise WarcError(f"not a record: {lines[0][:40]!r}")
            fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
            if not (length := fields.get("content-length", "")).isdigit():
                raise WarcError("record without a length")
            del buffer[:end + 4]
            for piece in pieces:
                buffer += piece
        except zlib.error as error:
            raise WarcError(str(error)) from error
        if buffer[int(length):] != b"\r\n\r\n":
            raise WarcError("record is longer or shorter than its length says")
        block = bytes(buffer[:int(length)])
        if fields.get("warc-block-digest") != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise WarcError("block does not match its digest")
        if fields.get("warc-type") == "response" and fields.get("warc-payload-digest") != fields["warc-block-digest"]:
            raise WarcError("payload does not match its digest")
        yield fields, block


def _number(field: str | None) -> int | None:
    return int(field.removeprefix("<urn:record:").removesuffix(">")) if field else None


def plan_records(pages: DataFrame, id_col: str, uri_col: str, payload_col: str,
                 least: int = REVISIT_BYTES) -> tuple[DataFrame, bool]:
    """Per row: key, id, uri, payload, digest, and `refers_to`: the key of the first row of equal payload, if another.
    Also whether keys are other than ids.

    Copies are first folded to digest, smallest key and count, so that a hot payload costs a row for each task. Only
    keys and digests meet in a join by digest, and adaptive execution may split it; payloads move once, by key.
    """
    body, uri = F.coalesce(F.col(payload_col).cast("string"), F.lit("")), F.col(uri_col).cast("string")
    rows, renumbered = keyed(pages.select(F.col(id_col), F.struct(body.alias("body"), uri.alias("uri")).alias("_page")), id_col, "_page")
    rows = rows.select(KEY, F.col(id_col).alias("_id"), F.col("_page.uri").alias("uri"), F.col("_page.body").alias("body"))
    marks = rows.select(KEY, F.sha2("body", 256).alias("digest"), F.octet_length("body").alias("size")).filter(F.col("size") >= least)
    firsts = marks.groupBy("digest").agg(F.min(KEY).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    revisits = marks.join(firsts, "digest").filter(F.col(KEY) != F.col("first")).select(KEY, F.col("first").alias("refers_to"))
    planned = rows.join(revisits, KEY, "left").select(
        KEY, "_id", "uri", F.col("body").cast("binary").alias("body"), F.sha2("body", 256).alias("digest"), "refers_to")
    return planned, renumbered


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records below `folder`, a URI every executor reaches; one row per finished archive."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        stream = None

        def finish():
            stream.close()
            store.move(part, part.removesuffix(".open"))
            return record(_ARCHIVE, [[part.removesuffix(".open")], [count], [size]])

        for batch in batches:
            for row in batch.to_pylist():
                if stream is None:
                    part, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz.open", 0, 0
                    stream = store.open_output_stream(part, compression=None)
                data = write_record(row[KEY], row["uri"], row["body"], row["digest"], row["refers_to"])
                stream.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    yield finish()
                    stream = None
        if stream is not None:
            yield finish()

    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    path = f"{folder}.list"
    planned.select(KEY, "uri", "body", "digest", "refers_to").mapInArrow(write, ARCHIVE_SCHEMA).write.parquet(path)
    return planned.sparkSession.read.schema(ARCHIVE_SCHEMA).parquet(path)


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives listed in column `path`; a task reads its archives one record at a time.

    `payloads=False` leaves the block out. A revisit has no block; its length and digest are those of the full payload.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for fields, block in read_records(stream):
                        refers = _number(fields.get("warc-refers-to"))
                        size = len(block) if refers is None else int(fields["x-payload-length"])
                        rows.append((_number(fields["warc-record-id"]), fields["warc-record-id"], fields["warc-target-uri"],
                                     block if payloads else None, size,
                                     fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"], refers))
                        held += len(block) if payloads else 100
                        if held > 1 << 22:
                            yield record(_RECORD, list(zip(*rows)))
                            rows, held = [], 0
                if rows:
                    yield record(_RECORD, list(zip(*rows)))

    # Archives are dealt out one by one: the list is small, the files are not.
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return archives.select("path").repartition(tasks, "path").mapInArrow(read, RECORD_SCHEMA)


def roundtrip(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
              least: int = REVISIT_BYTES) -> DataFrame:
    """Write a record per row, read the archives back, and give what was read, by `id_col`.

    Null payload: an empty one. Equal payloads of at least `least` bytes: the row with the smallest id is the response,
    the others revisit it; shorter ones are all responses. Null or repeated ids: each row has a record of its own, and
    ties are ordered by payload and uri. An empty table gives no archive and no row. Other columns are not read.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    planned, renumbered = plan_records(pages, id_col, uri_col, payload_col, least)
    records = read_archives(write_archives(planned, folder), folder, payloads=False).withColumnRenamed("record_key", "_id")
    if renumbered:
        ids = planned.select(KEY, F.col("_id").alias("_own"))
        firsts = ids.select(F.col(KEY).alias("refers_to"), F.col("_own").alias("_first"))
        records = records.join(ids, F.col("_id") == F.col(KEY)).drop("_id").join(firsts, "refers_to", "left").drop("refers_to")
        records = records.withColumnsRenamed({"_own": "_id", "_first": "refers_to"})
    return records.select(F.col("_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
