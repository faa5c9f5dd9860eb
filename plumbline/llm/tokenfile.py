"""Token files: ids packed in the fewest bits the vocabulary needs, in blocks with offsets.

A file set is a folder of Parquet parts, one part per doc_id range in ascending order, whose rows
are blocks: the ids of the part before the block, its documents, where each starts in it, and their ids bit-packed. As every
id has the same width, id number i of a block lies at bit i * width, so one document, or any run of
ids, is unpacked without reading what stands before it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, shared_path, small_batches, texts_of
from plumbline.llm.wordbpe import word_encoder

#: A block is closed by the document that brings it to so many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 16

SCHEMA = "part long, block long, inner long, n_ids long, width int, doc_ids array<long>, offsets array<long>, packed binary"


def width_of(vocabulary: int) -> int:
    """Bits that the largest id needs; at least 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive ``width``-bit numbers, lowest bit first, zero bits up to a whole byte."""
    if width % 8 == 0:
        return np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)[:, : width // 8].tobytes()
    bits = np.unpackbits(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(packed: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids number ``start`` to ``stop`` - 1, read from their own bytes only."""
    if stop <= start:
        return np.empty(0, np.uint32)
    first, last = start * width // 8, -(-stop * width // 8)
    raw = np.frombuffer(packed, np.uint8, last - first, first)
    if width % 8 == 0:
        whole = np.zeros((stop - start, 4), np.uint8)
        whole[:, : width // 8] = raw.reshape(stop - start, -1)
        return whole.view("<u4").ravel()
    bits = np.unpackbits(raw, bitorder="little")[start * width - first * 8 :][: (stop - start) * width].reshape(-1, width)
    full = np.zeros((stop - start, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text, append ``end_id`` and write the files in ascending doc_id order.

    Null texts are empty. A null doc_id comes first; rows of one doc_id stand together, ordered by
    text. An empty table writes no block. The texts are dealt by doc_id range before they are
    encoded, so that finding the ranges doesn't encode anything.
    """
    small_batches(docs.sparkSession)

    def run(batches: Batches) -> Batches:
        encoder, part = word_encoder(tokenizer), TaskContext.get().partitionId()
        width = width_of(encoder.size)
        end = np.array([end_id], encoder.dtype).tobytes()
        block, inner, held, n = 0, 0, [], 0

        def closed() -> pa.RecordBatch:
            ids = encoder.ids(b"".join(raw for _, raw in held))
            sizes = [len(raw) // encoder.dtype.itemsize for _, raw in held]
            offsets = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            packed = pack(ids, width)
            row = {"part": part, "block": block, "inner": inner, "n_ids": len(ids), "width": width, "doc_ids": [d for d, _ in held], "offsets": offsets.tolist(), "packed": packed}
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int64()), ("block", pa.int64()), ("inner", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("packed", pa.binary())]))

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch)), strict=True):
                held.append((doc_id, raw + end))
                n += len(raw) // encoder.dtype.itemsize + 1
                if n >= block_ids:
                    yield closed()
                    block, inner, held, n = block + 1, inner + n, [], 0
        if held:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    placed = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    placed.mapInArrow(run, SCHEMA).write.parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the number of ids in the blocks before.

    A block holds the count within its part; the sums of the parts before, one row a part and so one a
    writing task, are broadcast. Only the counts of the blocks are read for these.
    """
    held = spark.read.schema(SCHEMA).parquet(path)
    parts = held.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    base = parts.select(F.col("part").alias("of"), (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    return held.join(F.broadcast(base), F.col("part") == F.col("of")).withColumn("start", F.col("base") + F.col("inner")).drop("of", "base", "inner")


def read(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """``(doc_id, start, ids)`` of all documents, or of those in ``wanted``, unpacked block by block."""
    rows = blocks(spark, path)
    if wanted is not None:
        rows = rows.filter(F.arrays_overlap("doc_ids", F.array(*(F.lit(int(x)).cast("long") for x in wanted))))

    def each(row: dict) -> list[tuple]:
        edges = [*row["offsets"], row["n_ids"]]
        chosen = [i for i, d in enumerate(row["doc_ids"]) if wanted is None or d in wanted]
        return [(row["doc_ids"][i], row["start"] + edges[i], unpack(row["packed"], row["width"], edges[i], edges[i + 1])) for i in chosen]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                found = each(row)
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2].astype(np.int32) for x in found], pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return rows.mapInArrow(run, "doc_id long, start long, ids array<int>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, read back from them."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["packed"], row["width"], 0, row["n_ids"]).astype("<u4")
                edges = [*row["offsets"], row["n_ids"]]
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array([row["start"] + a for a in row["offsets"]], pa.int64()), pa.array(np.diff(edges), pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    small_batches(spark)
    return blocks(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` to a new folder in the shared storage and return the digests of what is read back."""
    path = shared_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id)
    return digests(docs.sparkSession, path)
