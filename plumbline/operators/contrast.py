"""Estimators that chained links are contrasted with; none of them is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contrast(cells: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Change between the first and last period by five other estimators, one row each.

    ``cells`` is read three times: for its periods, for the panel's lines (outlet, item) in one shuffle, whose sums by period
    serve four estimators, and for the outlets seen in every period. ``links`` isn't needed.
    """
    ends = cells.agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.count_distinct("ord").alias("periods"))
    rows = cells.select("outlet", "item", "ord", F.col("price").cast("double").alias("price"))
    line = Window.partitionBy("outlet", "item").orderBy("ord")
    told = F.col("outlet").isNotNull() & F.col("item").isNotNull() & (F.lag("ord").over(line) == F.col("ord") - 1)
    opened = F.first(F.struct("ord", "price")).over(line.rowsBetween(Window.unboundedPreceding, 0))
    lines = rows.select("ord", "price", F.when(told, F.lag("price").over(line)).alias("before"), F.coalesce(told, F.lit(False)).alias("matched"), opened.alias("opened")).crossJoin(F.broadcast(ends))
    both = F.col("matched") & F.col("price").isNotNull() & F.col("before").isNotNull()
    opening = F.when((F.col("ord") == F.col("last")) & (F.col("opened.ord") == F.col("first")), F.col("opened.price"))
    by_period = lines.groupBy("ord", "first", "last").agg(
        F.avg("price").alias("mean"), F.avg(F.log(F.col("price") / opening)).alias("endpoints"),
        (F.sum(F.when(F.col("matched"), F.col("price"))) / F.sum("before")).alias("dutot"), F.avg(F.when(both, F.col("price") / F.col("before"))).alias("carli"),
    )
    at = lambda c, end: F.max(F.when(F.col("ord") == F.col(end), F.col(c)))
    chain = lambda c: F.exp(F.sum(F.log(c))) - 1
    wide = by_period.agg((at("mean", "last") / at("mean", "first") - 1).alias("a"), (F.exp(at("endpoints", "last")) - 1).alias("b"), chain("dutot").alias("c"), chain("carli").alias("d"))
    out = wide.selectExpr("stack(4, 'simple mean', a, 'endpoints', b, 'chained Dutot', c, 'chained Carli', d) as (estimator, change)")
    own = lambda f, end: f(F.when(F.col("ord") == F.col(end), F.col("price"))).alias(f"{f.__name__}_{end}")
    outlets = rows.crossJoin(F.broadcast(ends)).filter("outlet is not null").groupBy("outlet").agg(F.count_distinct("ord").alias("seen"), F.first("periods").alias("periods"), *(own(f, end) for f in (F.sum, F.count) for end in ("first", "last")))
    mean = lambda end: F.try_divide(F.sum(f"sum_{end}"), F.sum(f"count_{end}"))
    whole = outlets.filter("seen = periods").agg((mean("last") / mean("first") - 1).alias("change"))
    return out.unionByName(whole.select(F.lit("balanced panel").alias("estimator"), "change"))
