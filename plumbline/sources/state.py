"""Batch state: fingerprints, versions, current attempts, pending batches, reconciliation, selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.keys import differs
from plumbline.sources.files import fingerprints  # noqa: F401  (the seal of a batch's file)


def rewritten(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """Periods whose file is another than the one last recorded.

    ``manifest`` (period, attempt, bytes, crc32), ``current`` (period, bytes, crc32). Another size
    is another file; equal sizes are compared by checksum if both are known.
    """
    last = manifest.groupBy("period").agg(F.max_by(F.struct("bytes", "crc32"), "attempt").alias("x")).select("period", F.col("x.bytes").alias("old_bytes"), F.col("x.crc32").alias("old_crc32"))
    rows = current.join(last, "period")
    other = differs(F.col("bytes"), F.col("old_bytes")) | F.coalesce(F.col("crc32") != F.col("old_crc32"), F.lit(False))
    return rows.filter(other).select("period", "old_bytes", "bytes")


def new_versions(registry: DataFrame, files: DataFrame) -> DataFrame:
    """``(file, version, sha256)`` of the files that are new or changed against their highest version."""
    last = registry.groupBy("file").agg(F.max("version").alias("last"), F.max_by("sha256", "version").alias("old"))
    rows = files.join(last, "file", "left").filter(F.col("old").isNull() | differs(F.col("sha256"), F.col("old")))
    return rows.select("file", (F.coalesce("last", F.lit(0)) + 1).alias("version"), "sha256")


def current(rows: DataFrame, batch: str | Sequence[str], attempt: str) -> DataFrame:
    """Rows of the highest attempt or version of each batch; one shuffle, by the batch."""
    keys = [batch] if isinstance(batch, str) else list(batch)
    last = rows.groupBy(*keys).agg(F.max(attempt).alias("_last"))
    return rows.join(last, keys).filter(F.col(attempt) == F.col("_last")).drop("_last").select(rows.columns)


def pending(manifest: DataFrame, table: DataFrame | None, keys: dict[str, str]) -> DataFrame:
    """Manifest rows whose keys (manifest column to table column) the table doesn't have yet; all, if there is no table."""
    if table is None:
        return manifest
    have = table.select(*(F.col(t).alias(f"_{m}") for m, t in keys.items())).distinct()
    on = [F.col(m).eqNullSafe(F.col(f"_{m}")) for m in keys]
    return manifest.join(have, on, "left_anti")


def unreconciled(table: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, rows, expected)`` of batches whose row count isn't the expected one (column expected)."""
    counted = table.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.join(expected, list(keys), "full_outer").filter(differs(F.col("rows"), F.col("expected"))).select(*keys, "rows", "expected")


def selected(asked: str, pending: DataFrame, known: DataFrame) -> DataFrame:
    """Periods (label) to compute: none asked means the pending ones, ``all`` the known ones, else a comma list.

    A label that isn't known raises.
    """
    text = asked.strip()
    if not text:
        return pending.select("label").distinct()
    if text == "all":
        return known.select("label").distinct()
    labels = sorted({x.strip() for x in text.split(",") if x.strip()})
    from plumbline.operators.gates import enforce, unknown_periods

    enforce(unknown_periods(known.sparkSession, labels, known), "unknown periods")
    return known.select("label").distinct().filter(F.col("label").isin(*labels))


def widened(batch: DataFrame, calendar: DataFrame) -> DataFrame:
    """The batch's periods and the one before each: what links of the batch are made from."""
    line = Window.orderBy("ord")
    before = calendar.select("label", "ord").distinct().withColumn("before", F.lag("label").over(line))
    return batch.select("label").unionByName(before.join(batch.select("label"), "label").select(F.col("before").alias("label")).filter("label is not null")).distinct()


def restricted(rows: DataFrame, periods: DataFrame, column: str) -> DataFrame:
    """Rows of the chosen periods (label); Spark sends the chosen ones to the rows if it finds them small."""
    return rows.join(periods.select(F.col("label").alias(column)).distinct(), column, "left_semi")


def without(rows: DataFrame, column: str, excluded: Sequence[str]) -> DataFrame:
    """Rows except those of excluded members; a null member stays."""
    return rows.filter(~F.coalesce(F.col(column).isin(*excluded), F.lit(False))) if excluded else rows
