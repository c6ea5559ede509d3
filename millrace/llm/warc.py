"""WARC archives: writing, normalising a monolithic gzip stream, reading by offset."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import scratch, small_batches, table

CHUNK, LEVEL = 1 << 20, 4
_ID = "urn:millrace:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, first: bool = False
) -> bytes:
    """One record, uncompressed. A revisit's block keeps the HTTP header alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members; an unfinished one is an error."""
    unzip, data, begun = zlib.decompressobj(31), b"", False
    while data := data or source.read(CHUNK):
        begun = True
        if out := unzip.decompress(data, CHUNK):
            yield out
        data = unzip.unconsumed_tail
        if unzip.eof:
            data, begun = unzip.unused_data, False
            unzip = zlib.decompressobj(31)
    while begun and not unzip.eof:  # what was read but held back
        out = unzip.decompress(b"", CHUNK)
        if not out and not unzip.eof:
            raise ValueError("the gzip stream ends early")
        yield out


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, their two closing line ends included. One record is held at a time."""
    held = bytearray()
    chunks = iter(chunks)

    def fill(size: int) -> bool:
        while len(held) < size:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while held or fill(1):
        at = held.find(b"\r\n\r\n")
        while at < 0:
            before = len(held)
            if not fill(before + 1):
                raise ValueError("a record's header ends early")
            at = held.find(b"\r\n\r\n", max(0, before - 3))
        length = re.search(rb"(?im)^content-length:\s*(\d+)", bytes(held[:at]))
        if not held.startswith(b"WARC/") or not length:
            raise ValueError("not a WARC record")
        end = at + 4 + int(length[1]) + 4
        if not fill(end) or held[end - 4 : end] != b"\r\n\r\n":
            raise ValueError("a record's block ends early")
        yield bytes(held[:end])
        del held[:end]


def parsed(raw: bytes) -> dict:
    """What a record says: type, page, length and digest of its full payload, reference."""
    head, _, block = raw[:-4].partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, v in re.findall(r"(?m)^([\w-]+):\s*(.*?)\r?$", head.decode())}
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload doesn't fit its digest")

    def page(name: str) -> int | None:
        number = fields.get(name, "").strip("<>").removeprefix(_ID)
        return int(number) if number else None

    return {
        "page_id": page("warc-record-id"),
        "url": fields["warc-target-uri"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": page("warc-refers-to"),
        "payload": None if revisit else payload,
    }


def normalise(source: BinaryIO, target: BinaryIO) -> Iterator[dict]:
    """Rewrite every record of one gzip stream as its own member; yield its index entry."""
    at = 0
    for raw in records(inflated(source)):
        press = zlib.compressobj(LEVEL, wbits=31)
        member = press.compress(raw) + press.flush()
        target.write(member)
        name = re.search(rb"(?im)^warc-record-id:\s*<?(.*?)>?\r?$", raw)
        yield {"offset": at, "length": len(member), "record_id": name[1].decode() if name else None}
        at += len(member)


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) as (page_id, url, payload, refers_to).

    Of equal payloads of at least ``least_bytes``, that of the largest page_id is
    the original; the others refer to it. The digest and length group them; the
    aggregate combines before its shuffle, and a payload that many pages share is a
    skewed join key, which adaptive execution splits.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"sha": F.unhex(F.sha1("payload")), "size": F.length("payload")})
    groups = (
        rows.groupBy("sha", "size")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & (F.col("size") >= least_bytes))
        .drop("n")
    )
    return rows.join(groups, ["sha", "size"], "left").select(
        "page_id",
        "url",
        "payload",
        F.when(F.col("original") > F.coalesce("page_id", F.lit(-(1 << 63))), F.col("original")).alias("refers_to"),
    )


def write_monolithic(rows: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Each task writes its rows as one archive, one gzip stream; (archive, n_records).

    A lost or repeated task writes another file; only those in the stored result count.
    """
    small_batches(rows.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        n, out, press = 0, None, zlib.compressobj(LEVEL, wbits=31)
        for batch in batches:
            for row in batch.to_pylist():
                out = out or store.open_output_stream(f"{base}/{name}", compression=None)
                out.write(press.compress(record(row["page_id"], row["url"], row["payload"], row["refers_to"], date)))
                n += 1
        if out:
            out.write(press.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "n_records": [n]})

    return table(rows.mapInArrow(work, "archive string, n_records bigint"), "warc-written")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Normalise each archive; (archive, index, n_records) of the new files.

    The sidecar has a line of JSON for each record: offset, length, record_id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                name = f"{archive.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
                origin, path = fs.FileSystem.from_uri(archive)
                n = 0
                with (
                    origin.open_input_stream(path, compression=None) as source,
                    store.open_output_stream(f"{base}/{name}", compression=None) as target,
                    store.open_output_stream(f"{base}/{name}.idx", compression=None) as index,
                ):
                    for entry in normalise(source, target):
                        index.write(json.dumps(entry).encode() + b"\n")
                        n += 1
                yield pa.RecordBatch.from_pydict(
                    {"archive": [f"{folder}/{name}"], "index": [f"{folder}/{name}.idx"], "n_records": [n]}
                )

    spread = archives.select("archive").repartition(max(1, archives.count()))
    return table(spread.mapInArrow(work, "archive string, index string, n_records bigint"), "warc-normalised")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of normalised archives, each read alone at its offset."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    if with_payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], schema + ", payload binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(archive)
                with store.open_input_stream(fs.FileSystem.from_uri(index)[1], compression=None) as f:
                    entries = [json.loads(x) for x in f.read().splitlines()]
                with store.open_input_file(path) as f:
                    for i in range(0, len(entries), 256):
                        found = [parsed(zlib.decompress(f.read_at(e["length"], e["offset"]), 31)) for e in entries[i : i + 256]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([x[n] for x in found], t) for n, t in zip(names, kinds, strict=True)], names
                        )

    return archives.select("archive", "index").repartition(max(1, archives.count())).mapInArrow(work, schema)


def archive_pages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as monolithic archives below ``folder`` and normalise them.

    Returns (archive, index, n_records). Null html: an empty payload. Null url:
    about:blank. Null page_id: a record without a number, never an original while
    another page has its payload. Rows that repeat page_id and html are each the
    response. Empty table: no archives. Other columns are ignored.
    """
    written = write_monolithic(with_references(pages, least_bytes), f"{folder}/monolithic")
    return normalise_archives(written, f"{folder}/normalised")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = archive_pages(pages, scratch(spark, "warc"))
    return read_archives(archives).drop("url")


OP7_SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS response
  FROM pages
)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substring(digest, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM payloads
"""
