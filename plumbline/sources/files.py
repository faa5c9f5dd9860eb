"""Checksums and encodings of files of any size, from the ranges in which Spark reads their lines.

A line feed is no part of another character in utf-8 or a code page, so a file is valid where all of its lines are,
however the ranges fall. The CRC of a file is combined from those of its pieces, which never leave their range.
SHA-256 needs a file in order: its pieces go to one task, which holds one of them at a time. A single line must fit a row.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.package import ship

#: Bytes of a piece.
PIECE = 1 << 20

# Fixed value: the polynomial of CRC-32, lowest power in the highest bit.
CRC_POLYNOMIAL = 0xEDB88320


def _product(a: int, b: int) -> int:
    """Product of two polynomials over two elements, modulo the CRC's; bit 31 is the power 0."""
    out = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            out ^= b
        b = b >> 1 ^ (CRC_POLYNOMIAL if b & 1 else 0)
    return out


def crc_after(first: int, second: int, length: int) -> int:
    """The CRC-32 of two byte strings one after the other, from those of each and the ``length`` of the second.

    The second moves the first ``8 * length`` powers on; that power of x comes by squaring.
    """
    power, square, left = 1 << 31, 1 << 30, 8 * length
    while left:
        if left & 1:
            power = _product(power, square)
        square, left = _product(square, square), left >> 1
    return _product(power, first) ^ second


def listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, uri, bytes)`` per file, without reading any. A file without a byte isn't listed by Spark's readers and gives no row anywhere here."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select("path", F.col("_metadata.file_path").alias("uri"), F.col("length").alias("bytes"))


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(uri, block, size, line)``: the lines of each file as bytes, without their line feeds, by the range they stand in.

    Rows of a range are in the file's order within their task.
    """
    rows = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    return rows.select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"))


def pieces(spark: SparkSession, paths: str | Sequence[str], content: bool = False) -> DataFrame:
    """``(uri, block, number, length, crc, shorter)``: the lines with their line feeds in pieces, by range and place; ``content`` too if asked.

    ``shorter`` is the piece's CRC without its last byte, which the file's last piece may not have.
    """
    schema = "uri string, block long, number long, length long, crc long, shorter long" + (", content binary" if content else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, held, size = None, 0, [], 0

        def closed() -> pa.RecordBatch:
            data = b"".join(held)
            columns = [pa.array([at[0]]), *(pa.array([x], pa.int64()) for x in (at[1], number, len(data), zlib.crc32(data), zlib.crc32(data[:-1])))]
            return pa.RecordBatch.from_arrays(columns + ([pa.array([data], pa.binary())] if content else []), names=[x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            for uri, block, line in zip(batch.column("uri").to_pylist(), batch.column("block").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if at != (uri, block) or size >= PIECE:
                    if held:
                        yield closed()
                    number, held, size = (number + 1 if at == (uri, block) else 0), [], 0
                    at = uri, block
                held += [line, b"\n"]
                size += len(line) + 1
        if held:
            yield closed()

    ship(spark)
    return lines(spark, paths).select("uri", "block", "line").mapInArrow(run, schema)


def checksums(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, bytes, crc32)`` per file, of any size: only a piece's CRC and length are shuffled."""

    def combined(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by([("block", "ascending"), ("number", "ascending")]).to_pylist()
        whole, total = 0, 0
        for i, r in enumerate(rows):
            spare = i == len(rows) - 1 and total + r["length"] > r["bytes"]  # the last line has no line feed
            length = r["length"] - spare
            whole, total = crc_after(whole, r["shorter"] if spare else r["crc"], length), total + length
        return pa.table({"uri": [rows[0]["uri"]], "crc32": pa.array([whole], pa.int64()), "seen": pa.array([total], pa.int64())})

    files = listed(spark, paths)
    found = pieces(spark, paths).join(files.select("uri", "bytes"), "uri").groupBy("uri").applyInArrow(combined, "uri string, crc32 long, seen long")
    fits = F.when(F.coalesce("seen", F.lit(0)) == F.col("bytes"), F.coalesce("crc32", F.lit(0).cast("long"))).otherwise(F.raise_error(F.concat(F.lit("read in part: "), "path")))
    return files.join(found, "uri", "left").select("path", "bytes", fits.alias("crc32"))


def fingerprints(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, sha256, bytes, crc32)`` per file, of any size; its pieces are shuffled once, to be hashed in order."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, state, crc, left = None, None, 0, 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([state.hexdigest()]), pa.array([crc], pa.int64())], names=["uri", "sha256", "crc32"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["uri"] != uri:
                    if state is not None:
                        yield closed()
                    uri, state, crc, left = r["uri"], hashlib.sha256(), 0, r["bytes"]
                data = r["content"][:left]
                state.update(data)
                crc, left = zlib.crc32(data, crc), left - len(data)
        if state is not None:
            yield closed()

    files = listed(spark, paths)
    rows = pieces(spark, paths, content=True).join(files.select("uri", "bytes"), "uri").repartition("uri").sortWithinPartitions("uri", "block", "number")
    found = rows.select("uri", "bytes", "content").mapInArrow(hashed, "uri string, sha256 string, crc32 long")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return files.join(found, "uri", "left").select("path", F.coalesce("sha256", empty).alias("sha256"), "bytes", F.coalesce("crc32", F.lit(0).cast("long")).alias("crc32"))


def described(spark: SparkSession, paths: str | Sequence[str], gap: str) -> DataFrame:
    """``(path, encoding, header)`` per file: utf-8 if all of its lines are, else cp1252 if no byte falls in the ``gap`` of that code page, else null.

    ``header`` has the first line's bytes without a carriage return. Lines are judged where they are.
    """
    rows = lines(spark, paths).select("uri", "block", F.monotonically_increasing_id().alias("place"), "line")
    latin = F.decode("line", "iso-8859-1")
    first = F.min_by("line", F.struct("block", "place"))
    found = rows.groupBy("uri").agg(F.bool_and(F.is_valid_utf8(F.col("line").cast("string"))).alias("utf8"), F.bool_and(~latin.rlike(gap)).alias("cp1252"), first.alias("first"))
    kind = F.when(F.coalesce("utf8", F.lit(True)), "utf-8").when(F.col("cp1252"), "cp1252")
    header = F.encode(F.regexp_replace(F.decode("first", "iso-8859-1"), "\r$", ""), "iso-8859-1")
    return listed(spark, paths).join(found, "uri", "left").select("path", kind.alias("encoding"), F.coalesce(header, F.lit(b"")).alias("header"))
