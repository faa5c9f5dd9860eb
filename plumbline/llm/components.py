"""Connected components of an edge table by alternating star contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links between ids of one orderable type to ``(id, root)`` for every linked id; root is the least id reached.

    Each round shuffles at most the links that are left and is written to the shared folder. Null
    ends and self-links are ignored; repeated links count once; no links give an empty table.
    """
    spark = edges.sparkSession
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        last, now = now, written(_small_star(_large_star(now)).distinct(), "stars")
        discard(spark, last)
        after = _mark(now)
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum: equal marks of two rounds mean that nothing moved."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", F.lit(1), "a"))).first()
    return tuple(row)
