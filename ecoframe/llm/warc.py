"""WARC archives as seekable Zstandard bundles.

A bundle is one file of independent zstd frames, each holding whole WARC
records (a record longer than ``frame_bytes`` has a frame of its own).  Two
skippable frames close it: an index ``record id -> (frame, offset inside the
decompressed frame, length)`` and the seek table of the zstd seekable format
(compressed and decompressed size of every frame, frame count, magic number).
One record is therefore read by decompressing one frame (`read_record`), and
every zstd tool can decompress the whole file.

Spark writes the files itself, so they can lie in any store and survive lost
executors: each bundle is one row and one file of the text writer.  That
writer ends a row with its line separator; the separator is set to the last
byte of the seek table's magic number and the row is written without it.

Payloads of at least ``min_dedup_bytes`` that are equal (SHA-256 of the whole
payload) are stored once, as the response record of the largest page id; the
others become revisit records that name it.

Defined cases: null html is an empty payload; rows with a null page id are
always responses; rows that repeat a winning page id are each written as a
response; control characters in a url are percent-encoded; an empty table
gives an archive without records.  Only id, url and html are read, so further
columns never clash.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SKIPPABLE_SEEK = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

RECORD_SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
                 "refers_to long, payload binary, record_id string, frame int, frame_offset long, record_bytes long")


def record_id(page_id: int | None, digest: str) -> str:
    """Of page and payload, so that two payloads under one page id are two records."""
    name = f"page:{page_id}:{digest}" if page_id is not None else f"payload:{digest}"
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"


def make_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> tuple[str, bytes]:
    """(record id, bytes of one WARC record); a revisit if ``refers_to`` is given."""
    rid = record_id(page_id, digest)
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {rid}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Collects records into frames and frames into one bundle."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes, self.level = frame_bytes, level
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.stored = 0

    def add(self, rid: str, record: bytes) -> None:
        if self.open and self.filled + len(record) > self.frame_bytes:
            self.end_frame()
        self.index.append((rid, len(self.frames), self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)

    def end_frame(self) -> None:
        if self.open:
            data = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(b"".join(self.open))
            self.frames.append(data)
            self.sizes.append((len(data), self.filled))
            self.stored += len(data)
            self.open, self.filled = [], 0

    def finish(self) -> bytes:
        self.end_frame()
        listing = zstandard.ZstdCompressor(level=self.level).compress(json.dumps(self.index).encode())
        index = struct.pack("<II", SKIPPABLE_INDEX, len(listing)) + listing
        sizes = [*self.sizes, (len(index), 0)]
        table = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
        return b"".join(self.frames) + index + struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of every frame before the table."""
    n, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    at, start, out = len(bundle) - 9 - n * width, 0, []
    for i in range(n):
        packed, plain = struct.unpack_from("<II", bundle, at + i * width)
        out.append((start, packed, plain))
        start += packed
    return out


def read_index(bundle: bytes) -> list[list]:
    """[record id, frame, offset in the decompressed frame, length] of every record."""
    start, size, _ = seek_table(bundle)[-1]
    magic, length = struct.unpack_from("<II", bundle, start)
    if magic != SKIPPABLE_INDEX or length + 8 != size:
        raise ValueError("no record index before the seek table")
    return json.loads(zstandard.ZstdDecompressor().decompress(bundle[start + 8:start + size]))


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    start, size, plain = frame
    return zstandard.ZstdDecompressor().decompress(bundle[start:start + size], max_output_size=plain)


def read_record(bundle: bytes, rid: str) -> bytes:
    """One record, from its frame alone."""
    for name, frame, offset, length in read_index(bundle):
        if name == rid:
            return read_frame(bundle, seek_table(bundle)[frame])[offset:offset + length]
    raise KeyError(rid)


def parse_record(data: bytes) -> dict:
    """The fields of one record; the digest of a response is computed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        found = hashlib.sha1(payload).hexdigest()
        if found != digest or len(payload) != length:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
            "payload_bytes": length, "payload_digest": digest, "refers_to": number("X-Refers-To-Page"),
            "payload": payload if fields["WARC-Type"] == "response" else None, "record_id": fields["WARC-Record-ID"]}


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_dedup_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, digest (SHA-1) and refers_to (null: a response)."""
    payload = F.encode(F.coalesce(pages[html_col].cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"),
                        payload.alias("payload"), F.unhex(F.sha2(payload, 256)).alias("key"))
    winners = (rows.filter((F.length("payload") >= min_dedup_bytes) & F.col("page_id").isNotNull())
               .groupBy("key").agg(F.max("page_id").alias("winner"), F.min("page_id").alias("lowest"))
               .filter("winner <> lowest").select("key", "winner"))
    return (rows.join(winners, "key", "left")
            .select("page_id", "url", "payload", F.sha1("payload").alias("digest"),
                    F.when(F.col("winner") != F.col("page_id"), F.col("winner")).alias("refers_to")))


def write_archive(records: DataFrame, path: str, frame_bytes: int = 256 << 10, bundle_bytes: int = 8 << 20,
                  level: int = 3, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes the rows of `plan_records` as bundles of about ``bundle_bytes``."""

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(w: BundleWriter) -> pa.RecordBatch:
            return pa.record_batch([pa.array([w.finish()[:-1]], pa.binary())], names=["bundle"])

        out = BundleWriter(frame_bytes, level)
        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers = (c[i].as_py() for c in cols)
                out.add(*make_record(page_id, url, payload, digest, refers, date))
                if out.stored >= bundle_bytes:
                    yield packed(out)
                    out = BundleWriter(frame_bytes, level)
        if out.index:
            yield packed(out)

    last = chr(SEEKABLE_MAGIC >> 24)
    (records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(bundles, "bundle binary")
     .select(F.col("bundle").cast("string"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", last).option("encoding", "ISO-8859-1").text(path))


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of every bundle, with its place: frame, offset, length."""

    names = [f.split(" ")[0] for f in RECORD_SCHEMA.split(", ")]
    types = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary(),
             "frame": pa.int32(), "frame_offset": pa.int64(), "record_bytes": pa.int64()}

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column(0):
                data = bundle.as_py()
                if not data:
                    continue
                table, rows, at, plain = seek_table(data), [], -1, b""
                for rid, frame, offset, length in read_index(data):
                    if frame != at:
                        if rows:
                            yield batch_of(rows)
                        at, plain, rows = frame, read_frame(data, table[frame]), []
                    row = parse_record(plain[offset:offset + length])
                    if row["record_id"] != rid:
                        raise ValueError(f"the index places {rid} where {row['record_id']} lies")
                    rows.append(row | {"frame": frame, "frame_offset": offset, "record_bytes": length}
                                | ({} if payloads else {"payload": None}))
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names=names)

    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(records, RECORD_SCHEMA))


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), w AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS winner FROM p
)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> winner THEN winner END AS refers_to
FROM w
"""
