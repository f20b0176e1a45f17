from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from recordforge.llm import archives

PAGES = [
    (1, "http://a.example/x y", "<p>same\r\n\r\nWARC/1.0</p>", 0),
    (2, "http://b.example/", "<p>same\r\n\r\nWARC/1.0</p>", 0),
    (3, None, None, 0),
    (4, "http://c.example/é", "", 0),
    (5, "http://d.example/", "ünïcode \n\n filedesc://x" * 5000, 0),
    (9, "http://e.example/", "<p>twice</p>", 0),
    (9, "http://e.example/", "<p>twice</p>", 0),
    (None, "http://f.example/", "<p>twice</p>", 0),
]
SCHEMA = "page_id long, url string, html string, block int"


def _expected(rows, min_bytes=0):
    out = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        first = max(ids, default=None)
        response = len(data) < min_bytes or first is None or page_id == first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
@pytest.mark.parametrize("size", [16 << 20, 900])
def test_round_trip(spark, tmp_path, monkeypatch, min_bytes, size):
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", size)
    archives.write_arc(spark.createDataFrame(PAGES, SCHEMA), f"{tmp_path}/arc")
    records = archives.read_arc(spark, f"{tmp_path}/arc")
    assert records.count() == len(PAGES)
    archives.write_warc(records, f"{tmp_path}/warc", min_bytes)
    found = archives.resolved(archives.read_warc(spark, f"{tmp_path}/warc"))
    rows = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found.collect()]
    assert sorted(rows, key=str) == _expected(PAGES, min_bytes)


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Two tasks with many pages, some far above the mean; each file starts with its version block."""
    limit, largest = 60_000, 400_000
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", limit)
    rows = [(i, f"http://x.example/{i}", "y" * (largest if i % 97 == 5 else 30_000 if i % 41 < 3 else i % 300), 0) for i in range(600)]
    archives.write_arc(spark.createDataFrame(rows, SCHEMA).repartition(2), f"{tmp_path}/arc")
    records = archives.read_arc(spark, f"{tmp_path}/arc")
    archives.write_warc(records.coalesce(2), f"{tmp_path}/warc")
    for kind in ("arc", "warc"):
        files = [gzip.decompress(p.read_bytes()) for p in (tmp_path / kind).glob("part-*")]
        assert len(files) > 10
        for data in files:
            records_in = list(archives.parse_arc(data) if kind == "arc" else archives.parse_warc(data))
            # Padding of the bound for one header line and the blank lines.
            assert len(data) < limit + 20_000 or len(records_in) == 1 and len(data) < largest + 20_000
            assert kind == "warc" or data.startswith(b"filedesc://")
    found = archives.resolved(archives.read_warc(spark, f"{tmp_path}/warc"))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found.collect()]
    assert sorted(got, key=str) == _expected(rows)


def test_both_versions_are_read_by_declared_lengths():
    for version in (1, 2):
        block = b"HTTP/1.1 200 OK\r\n\r\nbody\nhttp://x 0.0.0.0 20000101000000 text/html 3\n\n"
        data = archives.arc_version_block(version, "a.arc") + b"\n" + archives.arc_header(version, "http://x", "20010203040506", "text/html", len(block)) + block + b"\n"
        assert list(archives.parse_arc(data)) == [("http://x", "20010203040506", "text/html", block)]
        with pytest.raises(ValueError):
            list(archives.parse_arc(data[:-10]))
    with pytest.raises(ValueError):
        list(archives.parse_arc(archives.arc_version_block(1, "a.arc").replace(b"1 0 record", b"3 0 record")))


def test_records_hold_what_the_standard_asks():
    record = archives.warc_record("response", "http://x", archives.warc_date("20010203040506"), archives.record_id(4, "http://x", "d"), archives.sha1(b"body"), b"HTTP/1.1 200 OK\r\n\r\nbody")
    (head, block), = archives.parse_warc(record + b"\r\n\r\n")
    assert head["warc-date"] == "2001-02-03T04:05:06Z" and head["content-type"] == "application/http; msgtype=response"
    assert head["warc-record-id"].startswith("<urn:uuid:") and block.endswith(b"body")


def test_empty(spark, tmp_path):
    archives.write_arc(spark.createDataFrame([], SCHEMA), f"{tmp_path}/arc")
    assert archives.read_arc(spark, f"{tmp_path}/arc").count() == 0
