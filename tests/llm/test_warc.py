import gzip
import hashlib
import zlib

import pytest

from plumbline.llm import warc
from plumbline.llm.store import new_path

SCHEMA = "page_id bigint, url string, html string, digest int, salt string"


def trip(spark, rows):
    path = new_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    return path, warc.read_warc(spark, path).collect()


def test_round_trip_and_revisits(spark, monkeypatch):
    long, short = "é" * 60, "y" * 99
    rows = [
        (5, "http://a", long, 1, "x"), (3, None, long, 1, "x"), (9, "http://c\r\nX: y", long, 1, "x"), (1, "u", short, 1, "x"), (2, "u", short, 1, "x"), (4, "u", None, 1, "x"),
        (6, "u", "", 1, "x"), (None, "u", long, 1, "x"), (None, "u", "z" * 200, 1, "x"), (None, "u", "z" * 200, 1, "x"), (3, None, long, 1, "x"), (7, "u", "\x1f\x8b\0WARC/1.1\r\n\r\n" * 9999, 1, "x"),
    ]
    path, got = trip(spark, rows)
    assert len(got) == len(rows)
    wanted = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        revisit = html == long and page != 3
        wanted.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, None if revisit else raw))
    key = lambda r: str(r)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got], key=key) == sorted(wanted, key=key)
    # any gzip reader sees the records, one member each
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert sum(gzip.decompress(f).count(b"WARC-Record-ID") for f in files) == len(rows)
    assert all(f.endswith(b"\0") for f in files)


def test_empty_table(spark):
    assert trip(spark, [])[1] == []


def test_records_longer_than_an_archive_and_a_piece(spark, monkeypatch):
    noise = "".join(chr(33 + (i * i * 7919 + i // 3) % 90) for i in range(300_000))
    _, got = trip(spark, [(i, "u", noise + str(i), 0, "") for i in range(4)])
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, noise + str(i)) for i in range(4)]


def test_damage_is_found():
    raw = warc.member(1, "u", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None)
    record = zlib.decompress(raw, 31)
    assert [warc.read_record(r)[0] for r in warc.unpacked(raw + b"\0\0" + raw + b"\0")] == [1, 1]
    for bad in (record.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"), record[:-5], record + b"x", record.replace(b"WARC/1.1", b"HTTP/1.1"), b""):
        with pytest.raises(warc.Damaged):
            warc.read_record(bad)
    with pytest.raises(warc.Damaged):
        list(warc.unpacked(raw[:-9]))
    with pytest.raises(warc.Damaged):
        list(warc.unpacked(b"no gzip"))
