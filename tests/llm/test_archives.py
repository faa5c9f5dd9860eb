"""ARC files of both versions, their conversion, and WARC files read back, against plain parsing."""

import base64
import gzip
import hashlib
import re
import tempfile

import duckdb
import pytest

from plumbline.llm import archives as A
from plumbline.llm.queries import ORACLE_SQL, QUERIES

SAMPLE = "/root/testdata/sf0.001"
KIND = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows, least=0):
    best = {}
    for p, _, h in rows:
        best[h or ""] = max(best.get(h or "", p), p, key=lambda x: (x is not None, x or 0))
    out = []
    for p, _, h in rows:
        n, to = len((h or "").encode()), best[h or ""]
        revisit = n >= least and p != to
        out.append((p, n, digest(h), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def got(df, **kind):
    return sorted((tuple(r) for r in A.archived(df, **kind).collect()), key=str)


def test_sample_equals_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{SAMPLE}/pages.parquet'")
    expected = c.execute(f"select page_id, payload_bytes, payload_digest, record_type, refers_to from ({ORACLE_SQL['op11_archives']})").fetchall()
    assert sorted(tuple(r) for r in QUERIES["op11_archives"](spark, SAMPLE).collect()) == sorted(expected)


ODD = [
    (1, "http://a/x y", "same"), (2, None, "same"), (3, "http://a/ü\n", "same"), (7, "", None), (8, "u", ""), (None, "v", "same"), (None, "v", "nothing else"), (4, "w", "a\r\n\r\nHTTP/1.0 200 OK\r\nX-Page-Id: 99\r\n\r\nWARC/1.1"),
    (5, "x", "\0\n\0"), (6, "y", "é" * 200_000), (9, "z", "twice"), (9, "z", "twice"), (-3, "z", "twice"), (10, "q", "HTTP/1.1 404 no\n\n"),
]


def test_odd_pages_equal_plain_version(spark):
    df = spark.createDataFrame([(*r, "f", 1) for r in ODD], KIND + ", file string, type int")
    for pieces in (1, 4):
        assert got(df.repartition(pieces)) == plain(ODD)
    assert got(df, least_bytes=5) == plain(ODD, 5)
    assert got(df.limit(0)) == []


def test_files_and_revisits(spark):
    """Files close at their size, every record can be read from its offset, and digests hold."""
    base = tempfile.mkdtemp(prefix="spark-")
    rows = [(i, f"http://h/{i}", f"page {i % 40} " * 30) for i in range(200)]
    A.write_arc(spark.createDataFrame(rows, KIND).repartition(2), f"{base}/arc", file_bytes=2000)
    A.convert(spark, f"{base}/arc", f"{base}/warc", file_bytes=2000)
    files = spark.read.format("binaryFile").load(f"{base}/warc").collect()
    assert len(files) > 4
    index = A.read_warc(spark, f"{base}/warc", blocks=True).collect()
    assert all(r.problem is None and r.sound == 1 for r in index)
    assert sorted(r.page_id for r in index if r.type != "warcinfo") == list(range(200))
    assert sum(r.type == "response" for r in index) == 40 and sum(r.type == "warcinfo" for r in index) == len(files)
    by_id = {r.record_id: r for r in index}
    assert len(by_id) == len(index)
    content = {f.path: bytes(f.content) for f in files}
    for r in index:
        if r.type == "revisit":
            to = by_id[r.refers_to_id]
            assert to.type == "response" and to.page_id == r.page_id % 40 + 160 and to.payload_digest == r.payload_digest and r.block.endswith(b"\r\n\r\n")
        raw = next(A.warc_records(content[r.file][r.offset :]))
        assert bytes(r.block) == raw["block"] and raw["fields"]["content-length"] == str(len(r.block))
    whole = gzip.decompress(next(iter(content.values())))
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


# Written by hand after the format's description: a version block, then records of declared lengths.
OLD = b"filedesc://x.arc 0.0.0.0 19960923142103 text/plain 76\n1 0 Alexa Internet\nURL IP-address Archive-date Content-type Archive-length\n\n"
NEW = b"filedesc://y.arc 0.0.0.0 20010101000000 text/plain 200 - - 0 y.arc 124\n2 0 Alexa Internet\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n"


def opened(raw):
    head, body = raw.split(b"\n", 1)
    return re.sub(rb"\d+$", b"%d" % len(body), head) + b"\n" + body


def test_versions_of_the_header_line():
    old = opened(OLD) + b"\nhttp://a/with blank in it 1.2.3.4 19970102030405 text/html 12\nHTTP/1.0 200\n\ndns:a 1.2.3.4 1997 text/dns 5\na\n\nb\n\n"
    rows = list(A.arc_records(old))
    assert [(r["url"], r["date"], r["mime"], r["block"], r["status"]) for r in rows] == [("http://a/with blank in it", "19970102030405", "text/html", b"HTTP/1.0 200", None), ("dns:a", "1997", "text/dns", b"a\n\nb\n", None)]
    new = opened(NEW) + b"\nhttp://b/ 5.6.7.8 20020202020202 text/plain 404 abc - 124 y.arc 3\nx y\n"
    assert [(r["version"], r["status"], r["block"]) for r in A.arc_records(new)] == [(2, 404, b"x y")]
    packed = b"".join(map(gzip.compress, (opened(NEW), b"\nhttp://b/ 5.6.7.8 2002 text/plain 404 abc - 124 y.arc 3\nx y"))) + b"\0"
    assert [(r["block"], r["place"]) for r in A.arc_records(packed)] == [(b"x y", 0)]
    assert list(A.arc_records(b"")) == [] == list(A.warc_records(b""))


def test_damage_costs_its_own_member():
    parts = [opened(OLD), *(b"\nhttp://a/%d 1.2.3.4 19970102030405 text/html 3\nab%d" % (i, i) for i in range(4))]
    packed = [gzip.compress(p) for p in parts]
    broken = packed.copy()
    broken[2] = packed[2][:12] + b"\xff" * 6 + packed[2][18:]
    rows = list(A.arc_records(b"".join(broken)))
    assert [r.get("block") for r in rows] == [b"ab0", None, b"ab2", b"ab3"] and rows[1]["problem"] == "damaged member"
    problems = lambda record: [r.get("problem") for r in A.arc_records(opened(OLD) + record)]
    assert problems(b"\nhttp://a/ 1.2.3.4 1997 text/html 30\nabc") == ["short block"]
    assert problems(b"\nhttp://a/ text/html x\nabc") == ["header line"] == problems(b"\nno header")
    assert [r.get("problem") for r in A.arc_records(b"http://a/ 1.2.3.4 1997 text/html 3\nabc")] == ["header line"]
    assert [r.get("problem") for r in A.arc_records(opened(OLD).replace(b"\n1 0", b"\n2 0"))] == ["version"]
    assert [r["problem"] for r in A.warc_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")] == ["short block"]


def test_converted_kinds(spark):
    base = tempfile.mkdtemp(prefix="spark-")
    arc = opened(OLD) + b"\ndns:a 1.2.3.4 1997 text/dns 4\na\n\nb\nhttp://a/ 1.2.3.4 19970231000000 text/html 20\nHTTP/1.0 200 OK\n\nabc\nhttp://broken"
    spark.createDataFrame([(bytearray(arc),)], "data binary").select("data").transform(lambda d: A._write(d, f"{base}/arc") or d)
    A.convert(spark, f"{base}/arc", f"{base}/warc")
    rows = {r.url: r for r in A.read_warc(spark, f"{base}/warc", blocks=True).collect()}
    assert (rows["dns:a"].type, rows["dns:a"].date, bytes(rows["dns:a"].block)) == ("resource", "1997-01-01T00:00:00Z", b"a\n\nb")
    page = rows["http://a/"]
    assert (page.type, page.date, page.payload_bytes, page.payload_digest) == ("response", "1970-01-01T00:00:00Z", 3, digest("abc"))
    assert [r.problem for r in A.read_arc(spark, f"{base}/arc").filter("problem is not null").collect()] == ["header line"]


@pytest.mark.parametrize("date,expected", [("20000229235960", "2000-02-29T23:59:60Z"), ("199609", "1996-09-01T00:00:00Z"), ("19000229000000", "1970-01-01T00:00:00Z"), ("", "1970-01-01T00:00:00Z"), ("x", "1970-01-01T00:00:00Z")])
def test_dates(date, expected):
    assert A.timestamp(date) == expected
