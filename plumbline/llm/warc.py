"""WARC archives: written as one gzip member per record, read back sequentially.

Spark's own writer and reader move the bytes, so archives live wherever Spark can write and a lost
executor's files are never half there. An archive is a series of members; a zero byte, which gzip
readers skip as padding, ends the file.

Defined results: a null html is an empty payload; a null url is left out of the record. Payloads of
at least ``least`` bytes that are equal share one response, the row with the smallest page_id
(repeated rows of that page are responses too); nulls count as larger than every page_id, and
payloads that only null pages have are all responses. Extra columns are ignored. An empty table
gives an archive folder without records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an archive file, about; one record may be longer.
ARCHIVE = 8 << 20
#: Compressed bytes fed to zlib at a time.
FEED = 1 << 16
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def record_id(page_id: int | None) -> str:
    """Record ids of pages follow from the page, so that a revisit can name its response; a page without id gets a random one."""
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def member(page_id, url, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """One record as a gzip member. The payload of a revisit is not stored."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else url.translate({10: "%0A", 13: "%0D"})),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{sha256(block)}"),
        ("WARC-Profile", None if refers_to is None else REVISIT),
        ("WARC-Refers-To", None if refers_to is None else record_id(refers_to)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def archive() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
            page_id, url, html, digest, refers_to = row
            payload = html or b""
            held.append(member(page_id, url, payload, len(payload), digest, refers_to))
            size += len(held[-1])
            if size >= ARCHIVE:
                yield archive()
                held, size = [], 0
    if held:
        yield archive()


def write_warc(pages: DataFrame, path: str, least: int = 100) -> None:
    """Write a record per page. Only digests are compared: the first page of each repeated payload is
    found by an aggregation that combines before its shuffle, and joined back; the join is salted, as
    one payload may make up a large part of all pages."""
    salts = 16
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("html")
    ).select("*", F.sha2("html", 256).alias("digest"), (F.octet_length("html") >= least).alias("shared"))
    first = (
        rows.filter("shared").groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL")
        .select("digest", "first", F.lit(True).alias("shared"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    linked = salted.join(first, ["digest", "shared", "salt"], "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    archives = linked.select("page_id", "url", "html", "digest", refers_to.alias("refers_to")).mapInArrow(_members, "archive binary")
    # a text row is written byte for byte; the line end is the zero byte that closes the file
    archives.select(F.col("archive").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


# ------------------------------------------------------------------ reading


class Damaged(ValueError):
    """An archive that does not hold what it states."""


def unpacked(data) -> Iterator[bytes]:
    """The members of a gzip file in turn, decompressed piece by piece; padding of zero bytes is skipped."""
    view, at = memoryview(data), 0
    while at < len(view):
        if view[at] == 0:
            at += 1
            continue
        unzip, out = zlib.decompressobj(31), []
        while not unzip.eof:
            if at >= len(view):
                raise Damaged("the last member is cut short")
            feed = view[at : at + FEED]
            try:
                out.append(unzip.decompress(feed))
            except zlib.error as e:
                raise Damaged(str(e)) from e
            at += len(feed) - len(unzip.unused_data)
        yield b"".join(out)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-cased names) and block of the one record that a member must hold."""
    head, found, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not found or not first.startswith("WARC/"):
        raise Damaged("no record header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = int(fields.get("content-length", -1))
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise Damaged(f"record {fields.get('warc-record-id')} is not as long as it states")
    return fields, rest[:length]


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn and urn.startswith("<urn:page:") else None


def read_record(record: bytes) -> tuple:
    """(page_id, url, payload or None, payload_bytes, payload_digest, record_type, refers_to), digests verified."""
    fields, block = parsed(record)
    if fields.get("warc-block-digest") != f"sha256:{sha256(block)}":
        raise Damaged(f"block digest of {fields.get('warc-record-id')}")
    http, found, payload = block.partition(b"\r\n\r\n")
    lines = dict(x.lower().split(b": ", 1) for x in http.split(b"\r\n")[1:])
    size, digest = int(lines[b"content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    kept = fields["warc-type"] == "response"
    if not found or kept and (len(payload) != size or sha256(payload) != digest):
        raise Damaged(f"payload digest of {fields.get('warc-record-id')}")
    return (
        _page(fields["warc-record-id"]), fields.get("warc-target-uri"), payload if kept else None, size, digest, fields["warc-type"], _page(fields.get("warc-refers-to"))
    )


SCHEMA = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            held, size = [], 0
            for record in unpacked(content.as_buffer()):
                held.append(read_record(record))
                size += len(record)
                if size >= ARCHIVE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ARROW)], schema=_ARROW)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ARROW)], schema=_ARROW)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all records of the archives under a path; a damaged archive raises."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_records, SCHEMA)
