r"""Legacy archive converter: ARC version 1 and 2 to WARC 1.0, with identical-payload revisits, and a WARC reader.

An ARC file is a version block followed by records: a header line, as many bytes as its last field declares, a line feed.
Version 1 header lines are ``URL IP date type length``; version 2 adds result code, checksum, location, offset and file name
before the length.  The version block says which of them follows.  The converter reads by declared lengths only and
synthesises for each record a WARC-Record-ID (name-based, so a repeated task writes the same), a WARC-Date from the 14-digit
date, the type and Content-Type, and the payload digest.

``write_arc``, ``convert`` and ``write_warc`` write with Spark's text writer, whose line separator is the end of a record, and
read with its binary reader, so archives may lie in any store that Spark reaches.  Archives hold at most ``ARCHIVE_BYTES`` or one
record; a task holds one of them.  The writer starts a new file after a number of rows; an archive that is full before that is
filled up with empty rows, blank lines that compress to nothing.  Readers rely on declared lengths, never on separators, since
payloads may contain those.

Equal payloads are found by SHA-1: one maximum by digest and one join of digests, whose copies AQE may split.  The record of
the largest page_id is the response, the others refer to it; smaller ones than ``min_bytes`` are all responses.

Nulls: null html is empty; a null URL becomes ``urn:page:<page_id>``; white space in a URL is percent-encoded.  A null page_id
ranks below all others.  Rows that repeat the largest page_id with equal payload are all responses.  Empty tables give no
archives and no rows.  Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from recordforge.llm.common import saved, table
from recordforge.llm.registry import query
from recordforge.session import ensure_checkpoint_dir

ARCHIVE_BYTES = 16 << 20
DATE = "20000101000000"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs (fixed value)
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: Writer options: compressed, at the speed end.
FAST = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, uri: str, date: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id} {date} {uri}' if page_id is None else f'page {page_id}')}>"


def _address(url: str | None, page_id: int | None) -> str:
    return urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"


def _http(page_id: int | None, payload: bytes) -> bytes:
    own = b"" if page_id is None else f"X-Page-Id: {page_id}\r\n".encode()
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload


# ARC ---------------------------------------------------------------------------------------------------------------------


def arc_header(version: int, url: str, date: str, kind: str, length: int, offset: int = 0, name: str = "-") -> bytes:
    middle = "" if version == 1 else f"200 - - {offset} {name} "
    return f"{url} 0.0.0.0 {date} {kind} {middle}{length}\n".encode()


def arc_version_block(version: int, name: str, date: str = DATE) -> bytes:
    fields = "URL IP-address Archive-date Content-type " + ("" if version == 1 else "Result-code Checksum Location Offset Filename ") + "Archive-length"
    body = f"{version} 0 recordforge\n{fields}\n".encode()
    return arc_header(version, f"filedesc://{name}", date, "text/plain", len(body), 0, name) + body


class Filling:
    """Rows written to the files of a task, ``per_file`` rows each, and the bytes of the file that is open."""

    def __init__(self, per_file: int):
        self.per_file, self.rows, self.held = per_file, 0, 0

    def full(self, size: int) -> int:
        """Empty rows that end the open file before a record of ``size`` bytes."""
        used = self.rows % self.per_file
        if not used or not self.held or self.held + size <= ARCHIVE_BYTES:
            return 0
        self.rows += self.per_file - used
        return self.per_file - used

    def fresh(self) -> bool:
        """Whether the next row is the first of a file."""
        return self.rows % self.per_file == 0

    def add(self, size: int) -> None:
        self.held = size if self.fresh() else self.held + size
        self.rows += 1


def _arc_rows(batches: Iterable[pa.RecordBatch], date: str, per_file: int) -> Iterator[pa.RecordBatch]:
    """Rows (page_id, url, html) -> lines of ARC files of ``per_file`` lines at most; odd partitions are written in version 2."""
    part = TaskContext.get().partitionId()
    version, offset, files = 1 + part % 2, 0, Filling(per_file)
    for batch in batches:
        lines: list[str] = []
        for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = _http(page_id, (html or "").encode("utf-8", "surrogatepass"))
            lines += [""] * files.full(len(block) + 400)
            name = f"pages-{part:05d}-{files.rows // per_file:05d}.arc"
            if files.fresh():
                lines.append(arc_version_block(version, name, date).decode())
                offset = len(lines[-1]) + 1
                files.add(offset)
            head = arc_header(version, _address(url, page_id), date, "text/html", len(block), offset, name)
            offset += len(head) + len(block) + 1
            lines.append((head + block).decode("utf-8", "surrogatepass"))
            files.add(len(head) + len(block) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


def parse_arc(data: bytes) -> Iterator[tuple[str, str, str, bytes]]:
    """(url, date, type, block) of each record of an ARC file, by the header lines of its version and declared lengths."""
    at, fields = 0, 5
    while at < len(data):
        line = data.find(b"\n", at)
        if line < 0:
            break
        head = data[at:line].decode("utf-8", "replace").rstrip("\r").split(" ")
        if head == [""]:
            at = line + 1
            continue
        if head[0].startswith("filedesc://"):
            length = int(head[-1])
            version = data[line + 1 : line + 1 + length].split(b" ", 1)[0]
            if version not in (b"1", b"2"):
                raise ValueError(f"unknown ARC version {version!r}")
            fields = 5 if version == b"1" else 10
        else:
            if len(head) != fields or not head[-1].isdigit():
                raise ValueError(f"not an ARC header line: {head}")
            length = int(head[-1])
            yield head[0], head[2], head[3], data[line + 1 : line + 1 + length]
        if line + 1 + length > len(data):
            raise ValueError("an ARC record is shorter than declared")
        at = line + 1 + length + 1


# WARC --------------------------------------------------------------------------------------------------------------------


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def _page_of(http: bytes) -> int | None:
    found = re.search(rb"(?im)^X-Page-Id: (-?\d+)\r$", http)
    return int(found[1]) if found else None


def warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(kind: str, uri: str, date: str, ident: str, digest: str, block: bytes, refers_to: str | None = None) -> bytes:
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1(block)}", "Content-Type: application/http; msgtype=response"]
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block


def _whole(content: bytes) -> bytes:
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(out)


def _converted(batches: Iterable[pa.RecordBatch], blocks: bool) -> Iterator[pa.RecordBatch]:
    """ARC files -> (page_id, uri, date, digest, size, block)."""
    names = ["page_id", "uri", "date", "digest", "size", "block"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for uri, date, _, block in parse_arc(_whole(content.as_py())):
                http, payload = _split_http(block)
                rows.append((_page_of(http), uri, warc_date(date), sha1(payload), len(payload), zlib.compress(block, 1) if blocks else None))
                held += len(block)
                if held > ARCHIVE_BYTES // 4:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _warc_rows(batches: Iterable[pa.RecordBatch], min_bytes: int, per_file: int) -> Iterator[pa.RecordBatch]:
    """(page_id, uri, date, digest, size, block, first) -> WARC records as text; ``first`` is the page_id of the response."""
    files = Filling(per_file)
    for batch in batches:
        out: list[bytes] = []
        for page_id, uri, date, digest, size, block, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = zlib.decompress(block)
            ident = record_id(page_id, uri, date)
            if size < min_bytes or first is None or first == page_id:
                record = warc_record("response", uri, date, ident, digest, block)
            else:
                http = _split_http(block)[0]
                ident = f"<urn:uuid:{uuid.uuid5(SPACE, f'revisit {page_id} {date} {uri}')}>"
                record = warc_record("revisit", uri, date, ident, digest, http, record_id(first, uri, date))
            out += [b""] * files.full(len(record))
            out.append(record)
            files.add(len(record))
        yield pa.RecordBatch.from_arrays([pa.array([r.decode("utf-8", "surrogatepass") for r in out], pa.string())], names=["value"])


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of a WARC file, by declared lengths."""
    at = 0
    while at < len(data):
        if data.startswith((b"\r", b"\n"), at):
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("not a WARC record")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])}
        length = int(head["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) != length:
            raise ValueError("a WARC record is shorter than declared")
        yield head, block
        at = end + 4 + length


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_type", "record_id", "refers_to_id", "target_uri", "warc_date", "payload_digest", "payload_bytes"]
    kinds = [pa.int64(), *[pa.string()] * 6, pa.int64()]
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for head, block in parse_warc(_whole(content.as_py())):
                http, payload = _split_http(block)
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if sha1(block) != head["warc-block-digest"].removeprefix("sha1:"):
                    raise ValueError("a block digest does not match")
                full = head["warc-type"] == "response"
                if full and sha1(payload) != digest:
                    raise ValueError("a payload digest does not match")
                rows.append((_page_of(http), head["warc-type"], head["warc-record-id"], head.get("warc-refers-to"), head["warc-target-uri"], head["warc-date"], digest, len(payload) if full else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _per_file(records: DataFrame, size: F.Column) -> int:
    """Rows to a file, so that files of average records hold about ``ARCHIVE_BYTES``."""
    mean = records.agg(F.avg(size)).first()[0] or 0
    return max(2, int(ARCHIVE_BYTES // (mean + 400)))


def write_arc(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write (page_id, url, html) as compressed ARC files under ``path``, each task its own."""
    per_file = _per_file(pages, F.coalesce(F.octet_length("html"), F.lit(0)))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    lines = rows.mapInArrow(partial(_arc_rows, date=date, per_file=per_file), "value string")
    lines.write.mode("overwrite").options(lineSep="\n", maxRecordsPerFile=per_file, **FAST).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """(page_id, uri, date, digest, size, block) of the ARC records under ``path``; ``block`` is deflated, or null without ``blocks``."""
    return _files(spark, path).mapInArrow(partial(_converted, blocks=blocks), "page_id long, uri string, date string, digest string, size long, block binary")


def write_warc(records: DataFrame, path: str, min_bytes: int = 0, facts: DataFrame | None = None) -> None:
    """Write converted records as compressed WARC files; of equal payloads one is the response, the others revisit it.

    ``facts`` may give (page_id, digest, size) of the records, where that is cheaper than reading them once more.
    """
    facts = saved((records if facts is None else facts).select("page_id", "digest", "size"))
    first = facts.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("first"))
    rows = records.join(first, "digest", "left").select("page_id", "uri", "date", "digest", "size", "block", "first")
    per_file = _per_file(facts, F.col("size"))
    lines = rows.mapInArrow(partial(_warc_rows, min_bytes=min_bytes, per_file=per_file), "value string")
    lines.write.mode("overwrite").options(lineSep=END, maxRecordsPerFile=per_file, **FAST).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row of each record: ids, type, target, date, payload digest, and of responses the payload's length."""
    schema = "page_id long, record_type string, record_id string, refers_to_id string, target_uri string, warc_date string, payload_digest string, payload_bytes long"
    return _files(spark, path).mapInArrow(_read, schema)


def resolved(records: DataFrame) -> DataFrame:
    """Read records, revisits with the page_id and payload length of the response they refer to."""
    responses = records.where("record_type = 'response'")
    target = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("bytes"))
    rows = records.join(target, "refers_to_id", "left")
    return rows.withColumn("payload_bytes", F.coalesce("payload_bytes", "bytes")).drop("bytes", "refers_to_id")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    "op6_arc_to_warc",
    """with d as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
g as (select hex, max(page_id) as first from d group by hex),
b as (select *, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, i * 5 + 1, 5))::int) as v from d),
c as (select *, list_aggregate(list_transform(v, lambda x: list_aggregate(list_transform([15, 10, 5, 0],
  lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') as payload_digest from b)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to from c join g using (hex)""",
)
def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC archives, converted to WARC archives, read back."""
    arc, warc = _folder(spark, "arc"), _folder(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    write_warc(read_arc(spark, arc), warc, facts=read_arc(spark, arc, blocks=False))
    found = resolved(read_warc(spark, warc))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
