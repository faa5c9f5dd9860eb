"""Exact percentiles by distributed selection: no group's values meet in one buffer or task.

Equal values are counted where they are. A group's counts are summed by coarse buckets of value; running sums over the
buckets tell which ones hold the wanted ranks, and only these are opened. A bucket spans so few values that its own running
sum is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Digits of a value kept after the point, and bits of a bucket: up to 2^14 different values.
DIGITS, BUCKET_BITS = 4, 14


def value_counts(rows: DataFrame, by: Sequence[str], value: str, digits: int = DIGITS) -> DataFrame:
    """``(by, value, n)``: values as whole numbers of ``10 ** -digits``, nulls left out. ``value`` is a decimal of so many digits or fewer."""
    whole = F.col(value).cast(f"decimal(30,{digits})") * (10**digits)
    return rows.select(*by, whole.cast("long").alias("value")).filter("value is not null").groupBy(*by, "value").agg(F.count("*").alias("n"))


def percentiles(counts: DataFrame, by: Sequence[str], shares: dict[str, float], digits: int = DIGITS) -> DataFrame:
    """``(by, one column a share)``: percentiles interpolated between neighbours, as ``F.percentile`` gives them.

    ``counts`` comes from ``value_counts``. Null keys are groups like any other.
    """
    safe = lambda a, b: [F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}")) for c in by]
    coarse = counts.withColumn("_bucket", F.shiftright("value", BUCKET_BITS))
    sums = coarse.groupBy(*by, "_bucket").agg(F.sum("n").alias("_n"))
    group = Window.partitionBy(*by)
    upto = F.sum("_n").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    line = sums.withColumn("_before", upto - F.col("_n")).withColumn("_all", F.sum("_n").over(group))
    place = {n: F.lit(float(p)) * (F.col("_all") - 1) for n, p in shares.items()}
    wanted = F.inline(F.array(*(F.struct(F.lit(n).alias("_share"), edge.alias("_edge"), rank.cast("long").alias("_rank")) for n, p in place.items() for edge, rank in ((F.lit(0), F.floor(p)), (F.lit(1), F.ceil(p))))))
    asked = line.select(*by, "_bucket", "_before", "_n", "_all", wanted).filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
    asked = asked.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("_bucket").alias("_in"), "_before", "_all", "_share", "_edge", "_rank")
    opened = asked.select(*(f"_{c}" for c in by), "_in", "_before").distinct()
    inside = coarse.join(opened, [*safe("", "_"), F.col("_bucket") == F.col("_in")]).select(*by, "_bucket", "value", "n", "_before")
    last = F.sum("n").over(Window.partitionBy(*by, "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    ranked = inside.select(*by, "_bucket", "value", (last - F.col("n")).alias("_from"), last.alias("_to"))
    hit = ranked.join(asked, [*safe("", "_"), F.col("_bucket") == F.col("_in"), F.col("_rank") >= F.col("_from"), F.col("_rank") < F.col("_to")])
    ends = hit.groupBy(*by, "_share").agg(F.max(F.when(F.col("_edge") == 0, F.col("value"))).alias("_low"), F.max(F.when(F.col("_edge") == 1, F.col("value"))).alias("_high"), F.max("_all").alias("_all"))
    scale = float(10**digits)
    out = []
    for n, p in shares.items():
        part = F.lit(float(p)) * (F.col("_all") - 1)
        fraction = part - F.floor(part)
        low, high = F.col("_low") / scale, F.col("_high") / scale
        out.append(F.max(F.when(F.col("_share") == n, low + (high - low) * fraction)).alias(n))
    return ends.groupBy(*by).agg(*out)
