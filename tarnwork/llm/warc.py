"""WARC archives from a table of pages, by way of a chunked record table.

Payloads travel as rows ``(record, chunk, body, ...)`` of at most ``CHUNK`` bytes. Each
chunk carries the payload's length and SHA-1 up to its own end, so the last chunk has the
digest of the whole, and neither the writer nor the reader ever holds more than a chunk of
a record. Records are told apart by an identifier of their own, not by page id, so
repeated page ids are separate records.

Of records with equal payloads (length and SHA-1) of at least ``least`` bytes, the one with
the largest page id is written as response; the others become revisit records without a
payload that refer to it. A null page id is smaller than any other; of equal page ids one
is chosen. A null payload is an empty one, a null address is left out.

A record lies in one archive file, so a file can be as large as its largest record; files
are otherwise closed at ``ROLL`` bytes. Files of failed task attempts are never read: the
archive list has only what committed tasks report.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm import files
from tarnwork.llm.common import Scratch, batches, texts_of

CHUNK = 256 << 10
ROLL = 1 << 30

_CHUNKS = "record string, page_id long, url string, chunk long, last boolean, body binary, seen long, sha1 string"
_CHUNK_SCHEMA = pa.schema(
    [
        ("record", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("chunk", pa.int64()),
        ("last", pa.bool_()), ("body", pa.binary()), ("seen", pa.int64()), ("sha1", pa.string()),
    ]
)
_READ = _CHUNKS + ", record_type string, refers_to long"
_READ_SCHEMA = _CHUNK_SCHEMA.append(pa.field("record_type", pa.string())).append(pa.field("refers_to", pa.int64()))
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    chunk: int = CHUNK,
) -> DataFrame:
    """Payloads as rows of chunks; an empty payload has one empty chunk."""
    picked = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(payload_column).cast("binary").alias("payload"),
    )

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
        for page, url, payload in zip(ids, urls, texts_of(batch, "payload")):
            body, record, digest = memoryview(payload or b""), str(uuid.uuid4()), hashlib.sha1()
            count = max(1, -(-len(body) // chunk))
            for k in range(count):
                part = body[k * chunk : (k + 1) * chunk]
                digest.update(part)
                seen = k * chunk + len(part)
                yield record, page, url, k, k == count - 1, bytes(part), seen, _base32(digest.copy().digest())

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            yield from batches(_CHUNK_SCHEMA, rows(batch), 64)

    return picked.mapInArrow(run, _CHUNKS)


def decide_types(chunks: DataFrame, least: int) -> DataFrame:
    """``(record, bytes, digest, record_type, refers_to, refers_record)`` per record."""
    heads = chunks.where("last").select(
        "record", "page_id", F.col("seen").alias("bytes"), F.col("sha1").alias("digest")
    )
    first = (
        heads.where(F.col("bytes") >= least)
        .groupBy("digest", "bytes")
        .agg(F.max(F.struct("page_id", "record")).alias("first"))
    )
    again = F.col("first").isNotNull() & (F.col("first.record") != F.col("record"))
    return heads.join(first, ["digest", "bytes"], "left").select(
        "record",
        "bytes",
        "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first.page_id")).alias("refers_to"),
        F.when(again, F.col("first.record")).alias("refers_record"),
    )


def _clean(text: str) -> str:
    """A header value stays on its line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _head(row: dict, date: str) -> bytes:
    """WARC header and HTTP header of a record."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['bytes']}\r\n\r\n"
    ).encode()
    body = row["bytes"] if row["record_type"] == "response" else 0
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:uuid:{row['record']}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + body}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['url'])}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:uuid:{row['refers_record']}>"]
        if row["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page-ID: {row['refers_to']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(
    pages: DataFrame,
    spark: SparkSession,
    folder: str | None = None,
    least: int = 0,
    chunk: int = CHUNK,
    roll: int = ROLL,
    **columns: str,
) -> str:
    """Write a page table as archives and return their folder. Each record is a gzip
    member of its own; the table ``archives`` lists the files. ``columns`` names the
    columns as in ``chunk_table``."""
    scratch = Scratch(spark, "warc")
    folder = folder or scratch.path("set")
    chunks = scratch.save(chunk_table(pages, chunk=chunk, **columns), "chunks")
    types = scratch.save(decide_types(chunks, least), "types")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    written = F.col("record_type") == "response"
    rows = (
        chunks.join(types, "record")
        .where(written | (F.col("chunk") == 0))
        .withColumn("body", F.when(written, F.col("body")))
        # Numbering keeps a record's chunks together and in order.
        .withColumn("chunk", F.row_number().over(Window.partitionBy("record").orderBy("chunk")))
        .select(
            "record", "page_id", "url", "chunk", "body", "bytes", "digest", "record_type",
            "refers_to", "refers_record",
        )
    )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = member = name = None
        records = 0
        for batch in frames:
            for row in batch.to_pylist():
                if row["chunk"] == 1:
                    if member is not None:
                        out.write(member.compress(b"\r\n\r\n") + member.flush())
                    if out is not None and out.tell() >= roll:
                        out.close()
                        yield to_row(name, records)
                        out, records = None, 0
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out = files.create(f"{folder}/{name}")
                    member = zlib.compressobj(4, wbits=31)
                    out.write(member.compress(_head(row, date)))
                    records += 1
                if row["body"]:
                    out.write(member.compress(row["body"]))
        if out is not None:
            out.write(member.compress(b"\r\n\r\n") + member.flush())
            out.close()
            yield to_row(name, records)

    def to_row(name: str, records: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records])], names=["file", "records"])

    rows.mapInArrow(run, "file string, records long").write.parquet(f"{folder}/archives")
    scratch.drop("chunks", "types")
    return folder


def _headers(source) -> dict[str, str]:
    found: dict[str, str] = {}
    while line := source.readline().rstrip(b"\r\n"):
        name, _, value = line.decode("utf-8").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def parse_archive(source, bodies: bool = True, chunk: int = CHUNK) -> Iterator[tuple]:
    """Chunk rows of an archive, from a stream of its decompressed bytes. A response's
    digest is computed from what was read and has to agree with its header."""
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = _headers(source)
        length = int(head["content-length"])
        status = source.readline()
        at_body = len(status)
        http: dict[str, str] = {}
        while (raw := source.readline()) not in (b"\r\n", b"\n", b""):
            at_body += len(raw)
            name, _, value = raw.decode("utf-8").partition(":")
            http[name.strip().lower()] = value.strip()
        left = length - at_body - len(raw)
        record = head["warc-record-id"].removeprefix("<urn:uuid:").removesuffix(">")
        page, kind = _number(head.get("x-page-id")), head["warc-type"]
        fixed = (kind, _number(head.get("x-refers-to-page-id")))
        said = head["warc-payload-digest"].removeprefix("sha1:")
        url = head.get("warc-target-uri")
        if kind == "revisit":
            yield record, page, url, 0, True, None, int(http["content-length"]), said, *fixed
            continue
        digest, seen, k = hashlib.sha1(), 0, 0
        while True:
            body = source.read(min(chunk, left - seen))
            if not body and seen < left:
                raise ValueError(f"record {record} ends early")
            digest.update(body)
            seen += len(body)
            now = _base32(digest.copy().digest())
            if seen == left and now != said:
                raise ValueError(f"record {record} has another digest than its header")
            if bodies or seen == left:
                yield record, page, url, k, seen == left, body if bodies else None, seen, now, *fixed
            k += 1
            if seen == left:
                break


def read_archives(
    spark: SparkSession, folder: str, bodies: bool = True, chunk: int = CHUNK
) -> DataFrame:
    """The chunked record table of a folder of archives; without ``bodies`` one row per
    record, its last, with digest and length."""
    archives = spark.read.parquet(f"{folder}/archives").select("file")
    count = max(1, archives.count())

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for name in batch.column("file").to_pylist():
                with files.stream(f"{folder}/{name}") as raw, gzip.GzipFile(fileobj=raw) as source:
                    yield from batches(_READ_SCHEMA, parse_archive(source, bodies, chunk), 64 if bodies else 4096)

    return archives.repartition(count).mapInArrow(run, _READ)
