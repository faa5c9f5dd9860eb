"""Web archives: legacy ARC files of either version, their conversion to WARC, and WARC files read back.

An ARC file begins with a version block, whose header line tells the layout of all others; a record is one
header line and as many bytes as that line declares. The converter gives each record what WARC asks for and ARC lacks:
an identifier, a timestamp in ISO form, a type, digests, and revisits of equal payloads. Both kinds of file are written
with one gzip member a record, so a record can be read from its offset and a damaged one costs no other.

Files are made by Spark's text writer, one row a file, the bytes taken as they are; each ends in one zero byte, which gzip
readers pass over. So they go to any store that Spark writes to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, looked_up, shared_path, small_batches, written

#: Bytes after which a file is closed; a record is never cut.
FILE_BYTES = 16 << 20
#: gzip's effort.
EFFORT = 3

# The fields of a record's header line, by version of the format, and the media types of WARC blocks.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
HTTP_RESPONSE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PAGE_ID = "X-Page-Id"
_CHUNK = 1 << 16


def member(data: bytes) -> bytes:
    """``data`` as one gzip member, equal for equal bytes."""
    packer = zlib.compressobj(EFFORT, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(data: bytes) -> Iterator[tuple[int, bytes | None]]:
    """``(offset, bytes)`` of a file's gzip members; of a file that isn't compressed, the whole. Null bytes: a damaged stretch."""
    if data[:2] != b"\x1f\x8b":
        yield 0, data
        return
    view, at, sound = memoryview(data), 0, True
    while at < len(data) and data[at] != 0:
        inflater, out, place = zlib.decompressobj(31), [], at
        try:
            while not inflater.eof and place < len(data):
                out.append(inflater.decompress(view[place : place + _CHUNK]))
                place += _CHUNK
        except zlib.error:
            pass
        if inflater.eof:
            yield at, b"".join(out)
            at, sound = min(place, len(data)) - len(inflater.unused_data), True
            continue
        if sound:
            yield at, None
        found, sound = data.find(b"\x1f\x8b\x08", at + 1), False
        at = found if found >= 0 else len(data)


def _ended(text: bytes, at: int) -> bool:
    """Whether nothing follows but the zero byte that ends a file."""
    return at >= len(text) or at == len(text) - 1 and not text[at]


def _field(value: object, none: str = "-") -> str:
    """A value as a field of a header line: without white space and controls, never empty."""
    return quote(str(value), safe="%/:?#[]@!$&'()*+,;=~-._") if value not in (None, "") else none


def arc_header(version: int, **values: object) -> bytes:
    """A record's header line, with a line feed before and after it."""
    return ("\n" + " ".join(_field(values.get(f)) for f in ARC_FIELDS[version]) + "\n").encode()


def arc_opening(version: int, name: str, date: str) -> bytes:
    """The version block that opens a file."""
    body = f"{version} 0 plumbline\n{ARC_TITLES[version]}\n\n".encode()
    return arc_header(version, url=f"filedesc://{name}", ip="0.0.0.0", date=date, mime="text/plain", status=200, offset=0, filename=name, length=len(body))[1:] + body


def arc_records(data: bytes) -> Iterator[dict]:
    """Records of one ARC file: offset, place (in the member), version, the fields of the header line, block; or offset, place, problem.

    A member that can't be unpacked, a header line that doesn't fit the file's version and a block shorter than declared
    give a problem; what follows in the same member is lost then, other members aren't. The version block gives no record.
    """
    version = 0
    for offset, text in members(data):
        at, place = 0, 0
        if text is None:
            yield {"offset": offset, "place": 0, "problem": "damaged member"}
            continue
        while True:
            while text[at : at + 1] in (b"\n", b"\r"):
                at += 1
            if _ended(text, at):
                break
            end = text.find(b"\n", at)
            line = text[at : end if end >= 0 else len(text)].rstrip(b"\r").decode("utf-8", "replace")
            opening = line.startswith("filedesc://")
            if opening:
                version = next((v for v, f in ARC_FIELDS.items() if len(line.split(" ")) == len(f)), 0)
            fields = line.rsplit(" ", len(ARC_FIELDS[version]) - 1) if version else []  # blanks in a URL stand at the front
            found = dict(zip(ARC_FIELDS[version], fields, strict=False)) if version else {}
            if len(fields) != len(found) or not found or end < 0 or not found.get("length", "").isdecimal():
                yield {"offset": offset, "place": place, "problem": "header line"}
                break
            size = int(found["length"])
            block = text[end + 1 : end + 1 + size]
            if len(block) < size:
                yield {"offset": offset, "place": place, "problem": "short block"}
                break
            if opening and block[:2] != b"%d " % version:
                yield {"offset": offset, "place": place, "problem": "version"}
                break
            if not opening:
                status = found.get("status", "")
                yield {"offset": offset, "place": place, "version": version, "url": found["url"], "ip": found["ip"], "date": found["date"], "mime": found["mime"], "status": int(status) if status.isdecimal() else None, "block": block}
            at, place = end + 1 + size, place + 1


def timestamp(date: str) -> str:
    """An ARC date of 4 to 14 digits as a WARC date; what is missing is the earliest, and what is no date the start of 1970."""
    digits = date if date.isdecimal() and 4 <= len(date) <= 14 else "1970"
    y, m, d, h, i, s = (int(x) for x in re.match(r"(.{4})(..)(..)(..)(..)(..)", digits + "00000101000000"[len(digits) :]).groups())
    months = (31, 28 + (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)), 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
    sound = 1 <= m <= 12 and 1 <= d <= months[m - 1] and h < 24 and i < 60 and s < 61
    return f"{y:04}-{m:02}-{d:02}T{h:02}:{i:02}:{s:02}Z" if sound else "1970-01-01T00:00:00Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header, its empty line included, and payload of an HTTP response; of anything else nothing and the whole."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[: end.end()], block[end.end() :]) if end else (block, b"")


def http_value(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^%s[ \t]*:[ \t]*([^\r\n]*)" % re.escape(name.encode()), head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: object) -> str:
    """A record's URN, the same for the same parts."""
    return f"urn:uuid:{uuid.UUID(bytes=hashlib.sha1('|'.join(map(str, parts)).encode()).digest()[:16], version=5)}"


def warc_record(kind: str, block: bytes, **values: object) -> bytes:
    """A record as bytes; ``values`` are header fields, a name's underscores standing for hyphens. Null ones are left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k.replace('_', '-')}: {v}" for k, v in values.items() if v is not None), f"WARC-Block-Digest: sha1:{sha1(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warc_records(data: bytes) -> Iterator[dict]:
    """Records of one WARC file: offset, place, fields (names in lower case), block; or offset, place, problem."""
    for offset, text in members(data):
        at, place = 0, 0
        if text is None:
            yield {"offset": offset, "place": 0, "problem": "damaged member"}
            continue
        while not _ended(text, at):
            end = text.find(b"\r\n\r\n", at)
            head = text[at:end].decode("utf-8", "replace").split("\r\n") if end >= 0 else [""]
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
            size = fields.get("content-length", "")
            if not head[0].startswith("WARC/") or not size.isdecimal():
                yield {"offset": offset, "place": place, "problem": "header"}
                break
            block = text[end + 4 : end + 4 + int(size)]
            if len(block) < int(size):
                yield {"offset": offset, "place": place, "problem": "short block"}
                break
            yield {"offset": offset, "place": place, "fields": fields, "block": block}
            at, place = end + 4 + int(size), place + 1
            while text[at : at + 2] == b"\r\n":
                at += 2


# ---- the files in Spark


def _write(files: DataFrame, path: str) -> None:
    """One file for each row of ``files`` (data binary)."""
    files.select(F.col("data").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _filled(records: Iterator[bytes], opening, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Files of gzip members from records; ``opening(number)`` makes the first record of file ``number`` of the task."""
    number, held, size = 0, [], 0
    for record in records:
        packed = [member(record)] if held else [member(opening(number)), member(record)]
        held += packed
        size += sum(map(len, packed))
        if size >= file_bytes:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["data"])
            number, held, size = number + 1, [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["data"])


def write_arc(pages: DataFrame, path: str, date: str = "19960101000000", file_bytes: int = FILE_BYTES) -> None:
    """``pages`` (page_id, url, html) as ARC files, tasks of even number in version 1 and others in version 2.

    A record is an HTTP response whose header carries the page_id, unless that is null; a null url is ``about:blank``, a
    null html an empty payload.
    """

    def run(batches: Batches) -> Batches:
        task = TaskContext.get().partitionId()
        version = 1 + task % 2

        def records() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    payload = (html or "").encode()
                    head = ["HTTP/1.0 200 OK", "Content-Type: text/html; charset=utf-8", *([f"{PAGE_ID}: {page_id}"] if page_id is not None else []), f"Content-Length: {len(payload)}"]
                    block = "\r\n".join(head).encode() + b"\r\n\r\n" + payload
                    yield arc_header(version, url=url or "about:blank", ip="0.0.0.0", date=date, mime="text/html", status=200, length=len(block)) + block

        yield from _filled(records(), lambda n: arc_opening(version, f"{task:06}-{n:06}.arc", date), file_bytes)

    small_batches(pages.sparkSession)
    _write(pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "data binary"), path)


ARC_INDEX = "file string, offset long, place int, problem string, version int, url string, ip string, date string, mime string, status int, record_id string, page_id long, payload_bytes long, payload_digest string"


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Every record of the ARC files below ``path`` with what WARC will need; ``block`` too unless ``blocks`` is off.

    Damaged records are rows with a ``problem`` and nothing else but their place. A task holds one file and one record.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for rows in _groups(_described(file, data.as_py())):
                    yield pa.RecordBatch.from_pylist(rows, _arrow(schema))

    def _described(file: str, data: bytes) -> Iterator[dict]:
        for r in arc_records(data):
            r["file"] = file
            if "block" in r:
                block = r["block"] if blocks else r.pop("block")
                head, payload = split_http(block)
                number = http_value(head, PAGE_ID) or ""
                page_id = int(number) if re.fullmatch(r"-?\d{1,19}", number) else None
                r |= {"date": timestamp(r["date"]), "page_id": page_id, "payload_bytes": len(payload), "payload_digest": sha1(payload), "record_id": identifier(file, r["offset"], r["place"])}
            yield r

    schema = ARC_INDEX + (", block binary" if blocks else "")
    small_batches(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


def _groups(rows: Iterator[dict], most: int = 4 << 20) -> Iterator[list[dict]]:
    """Rows in lists of about ``most`` bytes of block, none empty."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 200 + len(r.get("block") or b"")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))])


def revisits(index: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(file, offset, place, to_id, to_url, to_date)`` of the records that revisit another.

    Of records with equal payloads of ``least_bytes`` or more, the one of the largest page_id is the response (null lowest;
    rows that share the largest are all responses), and the others refer to it, of several to the largest identifier.
    """
    rows = index.filter("problem is null").filter(F.col("payload_bytes") >= least_bytes)
    best = F.max(F.struct("page_id", "record_id", "url", "date"))
    groups = rows.groupBy("payload_digest", "payload_bytes").agg(best.alias("best"), F.count("*").alias("n")).filter("n > 1")
    named = groups.select("payload_digest", "payload_bytes", F.col("best.page_id").alias("to_page"), F.col("best.record_id").alias("to_id"), F.col("best.url").alias("to_url"), F.col("best.date").alias("to_date"))
    found = looked_up(rows.select("file", "offset", "place", "record_id", "page_id", "payload_digest", "payload_bytes"), named, ["payload_digest", "payload_bytes"], "record_id", "inner")
    return found.filter(~F.col("page_id").eqNullSafe(F.col("to_page"))).select("file", "offset", "place", "to_id", "to_url", "to_date")


def convert(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write the records of the ARC files below ``arc`` as WARC files below ``warc``.

    An HTTP response becomes a ``response``, or a ``revisit`` that keeps its HTTP header, if another record has its payload;
    anything else a ``resource``. Damaged records are left out; ``read_arc`` lists them. The files are read twice: for
    an index of digests, and for the blocks, which are shuffled once to meet what they refer to.
    """
    index = written(read_arc(spark, arc, blocks=False), "arc-index")
    other = written(revisits(index, least_bytes), "revisits")

    def run(batches: Batches) -> Batches:
        task = TaskContext.get().partitionId()

        def records() -> Iterator[bytes]:
            for batch in batches:
                for r in batch.to_pylist():
                    http, revisit = r["block"].startswith(b"HTTP/"), r["to_id"] is not None
                    head = split_http(r["block"])[0]
                    values = {"WARC_Target_URI": r["url"], "WARC_Date": r["date"], "WARC_IP_Address": None if r["ip"] in ("-", "0.0.0.0") else r["ip"], "WARC_Record_ID": f"<{r['record_id']}>", "WARC_Payload_Digest": f"sha1:{r['payload_digest']}", "X_Payload_Bytes": r["payload_bytes"]}
                    if revisit:
                        values |= {"WARC_Profile": REVISIT_PROFILE, "WARC_Refers_To": f"<{r['to_id']}>", "WARC_Refers_To_Target_URI": r["to_url"], "WARC_Refers_To_Date": r["to_date"]}
                    kind = "revisit" if revisit else "response" if http else "resource"
                    yield warc_record(kind, head if revisit else r["block"], **values, Content_Type=HTTP_RESPONSE if http else r["mime"])

        def opening(number: int) -> bytes:
            return warc_record("warcinfo", b"format: WARC File Format 1.1\r\nsoftware: plumbline\r\n", WARC_Date="1970-01-01T00:00:00Z", WARC_Record_ID=f"<{identifier(warc, task, number)}>", Content_Type="application/warc-fields")

        yield from _filled(records(), opening, file_bytes)

    at = ["file", "offset", "place"]
    rows = read_arc(spark, arc).filter("problem is null").select(*at, "url", "ip", "date", "mime", "record_id", "payload_bytes", "payload_digest", "block").join(other, at, "left")
    _write(rows.drop(*at).mapInArrow(run, "data binary"), warc)


WARC_INDEX = "file string, offset long, place int, problem string, type string, record_id string, url string, date string, refers_to_id string, payload_digest string, payload_bytes long, page_id long, sound int"


def read_warc(spark: SparkSession, path: str, blocks: bool = False) -> DataFrame:
    """Every record of the WARC files below ``path``; ``block`` too if asked.

    ``payload_digest`` is bare. ``sound`` is 1 if the block, and for a whole payload that too, has the digest it
    declares, else 0. Damaged records are rows with a ``problem``.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for rows in _groups(_described(file, data.as_py())):
                    yield pa.RecordBatch.from_pylist(rows, _arrow(schema))

    def _described(file: str, data: bytes) -> Iterator[dict]:
        bare = lambda x: x.strip("<>") if x else None
        digest = lambda x: x.partition(":")[2] if x else None
        for r in warc_records(data):
            r["file"] = file
            if "block" in r:
                fields, block = r.pop("fields"), r["block"] if blocks else r.pop("block")
                head, payload = split_http(block)
                number, size, kind = http_value(head, PAGE_ID) or "", fields.get("x-payload-bytes", ""), fields.get("warc-type")
                declared = digest(fields.get("warc-payload-digest"))
                whole = kind in ("response", "resource")
                fits = digest(fields.get("warc-block-digest")) in (None, sha1(block)) and (not whole or declared in (None, sha1(payload)))
                r |= {
                    "type": kind, "record_id": bare(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "refers_to_id": bare(fields.get("warc-refers-to")),
                    "payload_digest": sha1(payload) if whole else declared, "payload_bytes": len(payload) if whole else int(size) if size.isdecimal() else None,
                    "page_id": int(number) if re.fullmatch(r"-?\d{1,19}", number) else None, "sound": int(fits),
                }
            yield r

    schema = WARC_INDEX + (", block binary" if blocks else "")
    small_batches(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


def resolved(index: DataFrame) -> DataFrame:
    """``index`` (of ``read_warc``) with ``refers_to``: the page_id of the response that a revisit names; null for others."""
    rows = index.select("record_id", "type", "page_id", "payload_bytes", "payload_digest", "refers_to_id")
    named = rows.filter("type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    found = looked_up(rows.filter("type = 'revisit'"), named, ["refers_to_id"], "record_id")
    return rows.filter("type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long")).unionByName(found)


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from WARC files.

    ``pages`` (page_id, url, html) are written as ARC files of both versions to the shared folder, converted, and read
    again. A null html is an empty payload, a null page_id stays null and ranks lowest; rows that repeat a page_id
    are records of their own; extra columns are ignored and an empty table gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, least_bytes)
    index = written(read_warc(spark, warc), "warc-index")
    return resolved(index.filter("problem is null and type in ('response', 'revisit')")).select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")
