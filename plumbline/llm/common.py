"""What the operators of this subpackage share: shared storage, batching and tokenizer files."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.package import ship

#: Bytes of one Arrow batch: texts are long, so that Spark's 10,000 rows alone would be no bound.
BATCH_BYTES = 2 << 20

#: Tables up to this many rows (counted first) are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which every executor reaches.

    A local session without that setting gets a temporary folder; a cluster without it is an error,
    as a machine-local folder would lose files with its executor.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written once to the shared folder, in folders of the columns ``by``, and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    scratch_of(spark).append(path)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def scratch_of(spark: SparkSession) -> list[str]:
    """Paths of the tables that ``written`` made in this session and nothing has deleted."""
    context = spark.sparkContext
    if not hasattr(context, "_plumbline_scratch"):
        context._plumbline_scratch = []
    return context._plumbline_scratch


def discard(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete tables made by ``written``, given as frames or paths, whose last reader has been written itself."""
    known = scratch_of(spark)
    for path in (t if isinstance(t, str) else t.scratch_path for t in tables):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        if path in known:
            known.remove(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes that one Arrow batch brings into a Python worker, alike in all operators, and see that it has this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives memory back when its task ends: workers live on, idle beside those of later stages."""

    @wraps(run)
    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps what it has
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return through


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if its counted rows are within the bound."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def looked_up(rows: DataFrame, table: DataFrame, key: list[str], by: str, how: str = "left", salts: int = 16) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row a key at most; a key may hold any share of the rows.

    Rows are dealt by key and a salt from the column ``by``; each key and salt that occurs, counted before it is
    shuffled, gets its row of the table. ``rows`` is read twice. A null key finds nothing.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    asked = salted.select(*key, "_salt").distinct().join(table, key)
    return salted.join(asked, [*key, "_salt"], how).drop("_salt")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as Python strings, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def with_columns(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *new.values()], names=[*keep, *new])


def drawn(hashed: Column, most: int, n: int) -> Column:
    """True for about ``most`` of ``n`` rows: those whose 64-bit hash lies lowest; for all if there are no more."""
    return F.lit(True) if n <= most else hashed < F.lit(-(1 << 63) + (most << 64) // n)


def remainder(of: str, divisor: int):
    """crc32 of a column's text modulo ``divisor``; null for null."""
    return F.crc32(F.col(of).cast("string")) % divisor


Batches = Iterator[pa.RecordBatch]

PAGE_BITS = 15


def bit_map(hashes: DataFrame, places: int = 16, least_bits: int = 20, most_bits: int = 27) -> np.ndarray:
    """Bits that are set for the hashes (column h, long), at least ``places`` bits for each, 16 MB at most; built in pages by Spark.

    A hash that isn't among them may share a bit: what passes still has to be joined.
    """

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, slots in zip(batch.column("page").to_pylist(), batch.column("slots"), strict=True):
                bits = np.zeros(1 << PAGE_BITS, np.uint8)
                bits[slots.values.to_numpy(zero_copy_only=False)] = 1
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["page", "bits"])

    size = min(most_bits, max(least_bits, (places * hashes.count()).bit_length()))
    slot = F.pmod("h", F.lit(1 << size))
    paged = hashes.select(F.floor(slot / (1 << PAGE_BITS)).alias("page"), (slot % (1 << PAGE_BITS)).cast("int").alias("slot")).groupBy("page").agg(F.collect_set("slot").alias("slots"))
    whole = np.zeros((1 << (size - PAGE_BITS), 1 << (PAGE_BITS - 3)), np.uint8)
    found = paged.mapInArrow(pages, "page long, bits binary").toArrow()  # no more than the map itself, by one job
    for page, bits in zip(found.column("page").to_pylist(), found.column("bits").to_pylist(), strict=True):
        whole[page] = np.frombuffer(bits, np.uint8)
    return whole.ravel()


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    at = hashes.astype(np.int64) & np.int64(8 * len(bits) - 1)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
