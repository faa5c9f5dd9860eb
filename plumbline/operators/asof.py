"""As-of join: the last row of a table that began at or before a row's date, without an equality key or a range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days, seconds or units of a number that one window spans, and copies of each date's row for the join back.
SPAN, COPIES = 4096, 8


def _number(at: Column, kind: str) -> Column:
    """A date or time as a number that orders alike."""
    if kind == "date":
        return F.unix_date(at).cast("double")
    return F.unix_micros(at.cast("timestamp")) / 1e6 if kind.startswith("timestamp") else at.cast("double")


def as_of(rows: DataFrame, table: DataFrame, at: str, since: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``values`` of the table's row of the greatest ``since`` not after ``at``; null where there is none.

    ``by`` are columns that must be equal, null like any other value; there need be none. Of table rows with one ``since`` the one
    with the greatest values counts. A row with a null ``at`` finds nothing, a table row with a null ``since`` isn't found.

    Distinct dates of the rows stand in one line with those of the table, cut into spans of time: a window fills a span from its own
    table rows, and one small row a span carries the last ones on. The answer goes back to the rows by equality of the date,
    each date's row in ``COPIES``, so that a date with many rows is dealt to as many tasks.
    """
    key, kind = list(by), dict(rows.dtypes)[at]
    held = F.struct(*(F.col(v).alias(v) for v in values))
    place = lambda c, kind: F.floor(_number(F.col(c), kind) / SPAN)
    dates = rows.filter(F.col(at).isNotNull()).select(*key, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).alias("_v")).distinct()
    known = table.filter(F.col(since).isNotNull()).groupBy(*key, F.col(since).cast(kind).alias("_at")).agg(F.max(held).alias("_v")).select(*key, "_at", F.lit(0).alias("_side"), "_v")
    line = known.unionByName(dates.withColumn("_v", F.lit(None).cast(known.schema["_v"].dataType))).withColumn("_span", place("_at", kind))
    inside = Window.partitionBy(*key, "_span").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    own = line.withColumn("_own", F.last("_v", ignorenulls=True).over(inside)).filter("_side = 1")
    lasts = line.groupBy(*key, "_span").agg(F.max_by("_v", F.when(F.col("_side") == 0, F.col("_at"))).alias("_last"))
    carried = lasts.withColumn("_carried", F.last("_last", ignorenulls=True).over(Window.partitionBy(*key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)))
    carried = carried.select(*(F.col(k).alias(f"_c{i}") for i, k in enumerate(key)), F.col("_span").alias("_of"), "_carried")
    found = own.join(carried, [*(F.col(k).eqNullSafe(F.col(f"_c{i}")) for i, k in enumerate(key)), F.col("_span") == F.col("_of")])
    answer = found.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), "_at", F.coalesce("_own", "_carried").alias("_found"), F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("_copy"))
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64(*rows.columns), F.lit(COPIES)).cast("int"))
    on = [*(F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)), F.col(at) == F.col("_at"), F.col("_deal") == F.col("_copy")]
    return dealt.join(answer, on, "left").select(*rows.columns, *(F.col("_found")[v].alias(v) for v in values))
