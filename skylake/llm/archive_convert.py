"""Legacy web archives to WARC.

An ARC file is a version block and records: a header line whose fields depend on the version (1: address, IP, date, type, length;
2: address, IP, date, type, status, checksum, location, offset, file name, length), then as many bytes as declared, then a line end.
The converter reads by the declared lengths alone, so a payload may hold anything, and gives each record what WARC asks for: an id (the
same each time it is made), the 14-digit date as a timestamp, the type (a response if the block starts as HTTP, else a resource) and
SHA-1 digests of block and payload. Records whose payload equals that of another become revisits of one of them.

WARC files are written by Spark's text writer, a record per row with the record's closing line ends as separator, gzip-compressed, and
read back in streams: what the separator cut is put together again by the declared lengths, so a task holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylake.llm.common import bounded
from skylake.session import fresh_path

END = b"\r\n\r\n"
CAPTURED = "20200101000000"
# The field lines of the two ARC versions, and the profile of WARC 1.1 for revisits.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAFE = "!#$%&'()*+,/:;=?@[]~"


@dataclass
class ArcRecord:
    fields: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def write_arc(records: Iterator[tuple[str, str, bytes]], version: int = 2, name: str = "pages.arc", captured: str = CAPTURED) -> Iterator[bytes]:
    """An ARC file in pieces from (address, file name, block)."""
    body = f"{version} 0 skylake\n{FIELDS[version]}\n".encode()
    start = [f"filedesc://{name}", "0.0.0.0", captured, "text/plain"] + (["200", "-", "-", "0", name] if version == 2 else [])
    yield " ".join([*start, str(len(body))]).encode() + b"\n" + body + b"\n"
    for address, file, block in records:
        values = [quote(address, safe=_SAFE) or "-", "0.0.0.0", captured, "text/html"]
        if version == 2:
            values += ["200", "-", "-", "0", quote(file, safe=_SAFE) or "-"]
        yield " ".join([*values, str(len(block))]).encode() + b"\n" + block + b"\n"


def read_arc(file) -> Iterator[ArcRecord]:
    """Records of an ARC file object, the version block left out. Empty lines between records are skipped; a header line that has not
    the version's fields, or a block shorter than declared, raises ValueError with its place."""
    names: list[str] = []
    while line := file.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        values = line.decode("utf-8", "surrogateescape").split(" ")
        if not values[-1].isdigit():
            raise ValueError(f"no length in ARC header {line[:80]!r}")
        block = file.read(int(values[-1]))
        if len(block) < int(values[-1]):
            raise ValueError(f"ARC block of {line[:80]!r} ends after {len(block)} bytes")
        if values[0].startswith("filedesc://"):
            version = block.split(b" ", 1)[0]
            if version not in (b"1", b"2"):
                raise ValueError(f"unknown ARC version {version[:20]!r}")
            names = FIELDS[int(version)].split(" ")
            continue
        if len(values) != len(names):
            raise ValueError(f"ARC header has {len(values)} fields, not {len(names)}: {line[:80]!r}")
        yield ArcRecord(dict(zip(names, values)), block)


def _timestamp(date: str) -> str:
    d = (date + "00000101000000"[len(date):])[:14] if len(date) < 14 else date[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def payload_of(block: bytes) -> bytes:
    """The entity body of an HTTP response, the block itself of anything else."""
    if not block.startswith(b"HTTP/"):
        return block
    return block.partition(END)[2]


def warc_record(arc: ArcRecord, refers_to: str | None = None) -> bytes:
    """A WARC record up to, but without, its closing line ends; with `refers_to` (a file name) a revisit of that file's record."""
    http = arc.block.startswith(b"HTTP/")
    payload = payload_of(arc.block)
    name = arc.fields.get("Filename", "-")
    kind = "revisit" if refers_to is not None else "response" if http else "resource"
    block = arc.block if refers_to is None else arc.block[:len(arc.block) - len(payload)] if http else b""
    own = name if name != "-" else f"{arc.fields['URL']} {arc.fields['Archive-date']} {digest(arc.block)}"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(own)}", f"WARC-Date: {_timestamp(arc.fields['Archive-date'])}",
             f"WARC-Target-URI: {arc.fields['URL']}", f"WARC-IP-Address: {arc.fields['IP-address']}",
             f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
             f"X-Source-Filename: {name}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Filename: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines += [f"Content-Type: {'application/http; msgtype=response' if http else arc.fields['Content-type']}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + END + block


class _Bytes(io.RawIOBase):
    """A readable file over pieces of bytes."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            piece = next(self.pieces, None)
            if piece is None:
                return 0
            self.rest = piece
        n = min(len(buffer), len(self.rest))
        buffer[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def convert(spark: SparkSession, path: str) -> DataFrame:
    """WARC records (`file`, `record`) of the uncompressed or gzip ARC files below `path`; each file is read in one task."""
    import gzip

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                raw = io.BytesIO(content.as_py())
                file = gzip.GzipFile(fileobj=raw) if content.as_py()[:2] == b"\x1f\x8b" else raw
                for arc in read_arc(file):
                    yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([warc_record(arc)])], names=["file", "record"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, record binary")


def write_warc(records: DataFrame, path: str) -> None:
    """Write the column `record` as gzip WARC files."""
    records.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Headers and block of every record below `path`: (headers map, block). Revisits have a block without payload.

    The reader splits at the first of several line ends, so where a block ends in a line end of its own, part of the closing ones and the next
    record's headers arrive in one piece; that piece is cut at the declared length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        headers, size, need = None, 0, 0
        kind = pa.map_(pa.string(), pa.string())

        def start(chunk: bytes) -> None:
            nonlocal headers, need, size, parts
            lines = chunk.decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC header: {lines[0][:80]!r}")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            need, size, parts = int(headers["Content-Length"]), -len(END), []

        for batch in batches:
            out: list[tuple] = []
            for chunk in batch.column(0):
                chunk = chunk.as_py()
                if headers is None:
                    start(chunk)
                    continue
                parts.append(chunk)
                size += len(chunk) + len(END)
                if size < need:
                    continue
                whole = END.join(parts)
                if size > need and whole[need:need + len(END)] != END:
                    raise ValueError("WARC record is longer than declared")
                out.append((list(headers.items()), whole[:need]))
                headers = None
                if len(whole) > need + len(END):
                    start(whole[need + len(END):])
            columns = list(zip(*out)) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.binary())], names=["headers", "block"])
        if headers is not None:
            raise ValueError("WARC record is shorter than declared")

    rows = spark.read.option("lineSep", END.decode()).text(path).select(F.col("value").cast("binary").alias("value"))
    return rows.mapInArrow(run, "headers map<string,string>, block binary")


def _from_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages (id, url, html, refers to) as one ARC file per task, converted while it is written."""
    waiting: list[str | None] = []

    def blocks() -> Iterator[tuple[str, str, bytes]]:
        for batch in batches:
            for page, url, html, other in zip(*(batch.column(k) for k in range(4))):
                body = html.as_py() or b""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                waiting.append(None if other.as_py() is None else f"page-{other.as_py()}")
                yield url.as_py() or "-", f"page-{page.as_py()}", head.encode() + body

    out: list[bytes] = []
    size = 0
    for arc in read_arc(io.BufferedReader(_Bytes(write_arc(blocks())), 1 << 16)):
        out.append(warc_record(arc, waiting.pop(0)))
        size += len(out[-1])
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
            out, size = [], 0
    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", least: int = 0) -> DataFrame:
    """(`__page`, sha, `__to`): pages whose payload of at least `least` bytes, hashed to sha, equals that of the page with the larger id
    `__to`. Rows that repeat both id and payload are one capture and all responses."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.where(F.octet_length(html) >= least).select(F.col(id_col).alias("__page"), F.sha1(html).alias("sha"))
    last = rows.groupBy("sha").agg(F.max("__page").alias("__to"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "__to")
    return rows.join(last, "sha").where("__page < __to").select("__page", "sha", "__to").distinct()


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a WARC record per page below `path`. Null texts are empty payloads, null addresses are written as `-`."""
    other = bounded(revisits(pages, id_col, html_col), "revisits")
    rows = pages.select(F.col(id_col).alias("__page"), F.col(url_col).alias("__url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("__html"))
    rows = rows.withColumn("sha", F.sha1("__html")).join(other, ["__page", "sha"], "left").select("__page", "__url", "__html", "__to")
    write_warc(rows.mapInArrow(_from_pages, "record binary"), path)


def op8_warc(pages: DataFrame) -> DataFrame:
    path = fresh_path(pages.sparkSession, "warc")
    archive_pages(pages, path)
    back = read_warc(pages.sparkSession, path)
    value = lambda name: F.col("headers")[name]
    page = lambda c: F.regexp_extract(c, r"^page-(-?\d+)$", 1).try_cast("bigint")
    return back.select(
        page(value("X-Source-Filename")).alias("page_id"), value("X-Payload-Length").cast("bigint").alias("payload_bytes"),
        F.substr(value("WARC-Payload-Digest"), F.lit(6)).alias("payload_digest"), value("WARC-Type").alias("record_type"),
        page(F.coalesce(value("X-Refers-To-Filename"), F.lit(""))).alias("refers_to"))


SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
d as (
  select hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31)::int, 1), '' order by i, s desc) as digest
  from (select hex, i, ('0x' || substr(hex, 1 + 5 * i, 5))::int as v from (select distinct hex from p), unnest(range(8)) as t(i)),
    unnest([15, 10, 5, 0]) as u(s)
  group by hex),
l as (select hex, max(page_id) as last from p group by hex)
select page_id, strlen(html)::bigint as payload_bytes, digest as payload_digest,
  case when page_id < last then 'revisit' else 'response' end as record_type, case when page_id < last then last end as refers_to
from p join d using (hex) join l using (hex)
"""
