"""Surrogate keys and content checksums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key(*columns: str | Column) -> Column:
    """Surrogate key of a natural key, without a lookup.

    The hash passes over nulls, so ``("a", null)`` and ``(null, "a")`` get one key: natural keys must
    pass the completeness gate before they are hashed.
    """
    return F.xxhash64(*columns)


def seal(content: str | Column) -> dict[str, Column]:
    """Checksums that tell one version of a file's bytes from another."""
    column = F.col(content) if isinstance(content, str) else content
    return {"sha256": F.sha2(column, 256), "bytes": F.length(column).cast("long"), "crc32": F.crc32(column)}


def differs(left: Column, right: Column) -> Column:
    """True if two values differ, null being a value like any other."""
    return ~left.eqNullSafe(right)
