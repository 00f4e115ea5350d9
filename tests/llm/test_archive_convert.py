"""Archive conversion: exact round trips through both formats, and SQL."""

import base64
import gzip
import hashlib
import io

import pytest
from compare import compare, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from skylake.llm import archive_convert as A
from skylake.llm import queries

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string"


@given(st.lists(st.tuples(st.text(max_size=10), st.binary(max_size=30) | st.sampled_from([b"\r\n\r\n", b"\n\n", b"WARC/1.1\r\n", b""])), max_size=6), st.sampled_from([1, 2]))
@settings(max_examples=200, deadline=None)
def test_arc_round_trip(records, version):
    data = b"".join(A.write_arc(((u, f"f {k}", b) for k, (u, b) in enumerate(records)), version))
    back = list(A.read_arc(io.BytesIO(data)))
    assert [r.block for r in back] == [b for _, b in records]
    assert all(len(r.fields) == (5 if version == 1 else 10) for r in back)


def test_bad_archives():
    good = b"".join(A.write_arc(iter([("http://a/", "f", b"abc")]), 1))
    for bad in (good[:-3], good.replace(b"text/html 3", b"text/html x"), good.replace(b"http://a/", b"http://a/ b"), good.replace(b"1 0 sky", b"9 0 sky")):
        with pytest.raises(ValueError):
            list(A.read_arc(io.BytesIO(bad)))


def test_warc_record():
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody"
    arc = A.ArcRecord(dict(zip(A.FIELDS[1].split(), ["http://a/", "1.2.3.4", "20010203040506", "text/html", "29"])), block)
    text = A.warc_record(arc).decode()
    want = base64.b32encode(hashlib.sha1(b"body").digest()).decode()
    assert "WARC-Type: response\r\n" in text and f"WARC-Payload-Digest: sha1:{want}" in text and "WARC-Date: 2001-02-03T04:05:06Z" in text
    assert text.endswith(f"Content-Length: {len(block)}\r\n\r\n{block.decode()}") and A.warc_record(arc) == A.warc_record(arc)
    plain = A.warc_record(A.ArcRecord(arc.fields, b"GIF89")).decode()
    assert "WARC-Type: resource" in plain and "Content-Type: text/html" in plain
    again = A.warc_record(arc, "page-9").decode()
    assert "WARC-Type: revisit" in again and f"WARC-Refers-To: {A.record_id('page-9')}" in again and again.endswith("A: b\r\n\r\n")


def brute(rows):
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        old = i < last[h or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if old else "response", last[h or ""] if old else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/ b\n", "<p>same é</p>"), (2, None, "<p>same é</p>"), (3, "http://c/", None), (4, "http://d/", ""), (5, "u", "x\r\n\r\ny\r\n\r\n"), (6, "u", "\r\n\r\n"),
        (7, "u", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n"), (8, "u", "long " * 300000), (9, "u", "<p>same é</p>"), (9, "u", "<p>same é</p>"), (10, "u", "one"), (10, "u", "two"),
        (11, "u", "two"), (-3, "u", "HTTP/1.1 in the text\r\n\r\nrest")]


def test_awkward_rows(spark):
    frame = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 as sha", "2 as record", "3 as headers", "4 as block", "5 as n").repartition(3)
    assert sorted(map(tuple, A.op8_warc(frame).collect()), key=repr) == brute(ROWS)


def test_null_ids(spark):
    got = A.op8_warc(spark.createDataFrame([(None, "u", "a"), (None, "u", "a"), (1, "u", "a")], PAGES)).collect()
    assert sorted((r.page_id is None, r.record_type, r.refers_to) for r in got) == [(False, "response", None), (True, "response", None), (True, "response", None)]


def test_empty_table(spark):
    assert A.op8_warc(spark.createDataFrame([], PAGES)).count() == 0


def test_files_are_converted(spark, tmp_path):
    data = b"".join(A.write_arc(iter([("http://a/", "f", b"HTTP/1.1 200 OK\r\n\r\nbody"), ("http://b/", "g", b"raw")]), 1))
    (tmp_path / "one.arc").write_bytes(data)
    (tmp_path / "two.arc.gz").write_bytes(gzip.compress(data))
    found = A.convert(spark, str(tmp_path))
    assert found.count() == 4
    A.write_warc(found, str(tmp_path / "warc"))
    back = A.read_warc(spark, str(tmp_path / "warc")).collect()
    assert sorted(bytes(r.block) for r in back) == sorted([b"HTTP/1.1 200 OK\r\n\r\nbody", b"raw"] * 2)
    written = next((tmp_path / "warc").glob("*.gz"))
    assert gzip.decompress(written.read_bytes()).startswith(b"WARC/1.1\r\n") and gzip.decompress(written.read_bytes()).endswith(b"\r\n\r\n")


def test_same_as_sql(spark):
    assert compare(spark, duck(SF_DIR), "op8", queries.QUERIES["op8_warc"], A.SQL, SF_DIR) is None


TAILS = ["\r\n", "\r\n\r\n\r\n", "\r\n\r\n", "\r", "\r\r\n", "\n", "\r\n\r", "\r\n\n", "\r\n\r\n\r", ""]


@pytest.mark.parametrize("parts", [1, 4])
def test_payloads_that_end_in_line_ends(spark, parts):
    rows = [(i, "u", f"{text}{tail}") for i, (text, tail) in enumerate((a, b) for b in TAILS for a in (f"abc{TAILS.index(b)}", ""))]
    assert sorted(map(tuple, A.op8_warc(spark.createDataFrame(rows, PAGES).repartition(parts)).collect()), key=repr) == brute(rows)


def test_wrong_lengths_are_refused(spark, tmp_path):
    for k, n in enumerate((2, 9)):
        (tmp_path / f"{k}.warc").write_bytes(f"WARC/1.1\r\nContent-Length: {n}\r\n\r\nabc\r\n\r\n".encode())
        with pytest.raises(Exception, match="than declared"):
            A.read_warc(spark, str(tmp_path / f"{k}.warc")).collect()
