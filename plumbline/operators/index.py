"""Chained index, publication guard, deflation: measures over links, per group and selected periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLD, FLOOR = 30.0, 10


def per_period(links: DataFrame, by: list[str]) -> DataFrame:
    """Mean log relative and matched outlets of each group and period; every cell counts once, one with a null relative not at all."""
    return links.filter(F.col("log_rel").isNotNull()).groupBy(*by, "ord").agg(F.avg("log_rel").alias("mean_rel"), F.count_distinct("outlet").alias("matched"), F.count("*").alias("cells"))


def publishable(effective: Column, least: Column, threshold: float = THRESHOLD, floor: int = FLOOR) -> Column:
    return F.coalesce((effective >= threshold) & (least >= floor), F.lit(False))


def match_summary(links: DataFrame, by: list[str], threshold: float = THRESHOLD, floor: int = FLOOR) -> DataFrame:
    """Per group over its links: number, least, median and effective (harmonic mean) match, thin links, guard."""
    n = per_period(links, by)
    out = n.groupBy(*by).agg(
        F.count("*").alias("n_links"), F.min("matched").alias("least_match"), F.median("matched").alias("median_match"),
        (F.count("*") / F.sum(1 / F.col("matched"))).alias("effective_match"), F.count_if(F.col("matched") < threshold).alias("thin_links"),
    )
    return out.withColumn("publish", publishable(F.col("effective_match"), F.col("least_match"), threshold, floor))


def chained_change(links: DataFrame, by: list[str], threshold: float = THRESHOLD, floor: int = FLOOR) -> DataFrame:
    """Change over the selected links, ``exp(sum of period means) - 1``; null where the guard says no."""
    n = per_period(links, by)
    out = n.groupBy(*by).agg((F.count("*") / F.sum(1 / F.col("matched"))).alias("effective_match"), F.min("matched").alias("least_match"), F.sum("mean_rel").alias("total"))
    change = F.when(publishable(F.col("effective_match"), F.col("least_match"), threshold, floor), F.exp("total") - 1)
    return out.select(*by, "effective_match", "least_match", change.alias("change"))


def chained_index(links: DataFrame, cells: DataFrame, calendar: DataFrame, by: list[str], threshold: float = THRESHOLD, floor: int = FLOOR) -> DataFrame:
    """Index (base 100) of every group at every period of ``calendar`` (ord).

    Carries flat through a period without a link. At the calendar's first period it is 100 if the
    group has a price there. Elsewhere it is null unless the links from the base to that point,
    taken together, pass the guard. Groups are those of ``cells`` (with ``by`` columns).
    """
    groups = cells.select(*by).distinct() if by else cells.sparkSession.range(1).select()
    base = calendar.agg(F.min("ord").alias("base"))
    at_base = cells.join(F.broadcast(base), F.col("ord") == F.col("base"), "left_semi").select(*by, F.lit(True).alias("priced")).distinct()
    grid = groups.crossJoin(calendar.select("ord").distinct()).crossJoin(base)
    null_safe = lambda a, b, names: [a[c].eqNullSafe(b[c]) for c in names]
    stats = per_period(links, by)
    on = [*null_safe(grid, stats, by), grid["ord"] == stats["ord"]]
    rows = grid.join(stats, on, "left").select(*(grid[c] for c in [*by, "ord", "base"]), "mean_rel", "matched")
    rows = rows.join(at_base, null_safe(rows, at_base, by), "left").select(*(rows[c] for c in rows.columns), "priced") if by else rows.join(F.broadcast(at_base.limit(1)), F.lit(True), "left")
    line = Window.partitionBy(*by).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    effective = F.count("matched").over(line) / F.sum(1 / F.col("matched")).over(line)
    ok = publishable(effective, F.min("matched").over(line), threshold, floor)
    level = F.exp(F.sum("mean_rel").over(line)) * 100
    index = F.when(F.col("ord") == F.col("base"), F.when(F.col("priced"), F.lit(100.0))).otherwise(F.when(ok, level))
    return rows.select(*by, "ord", "matched", index.alias("index"))


def threshold_scan(links: DataFrame, by: list[str], floor: int = FLOOR) -> DataFrame:
    """Whether each group would be published at thresholds 5, 10, ... 200."""
    summary = match_summary(links, by).select(*by, "effective_match", "least_match")
    steps = links.sparkSession.range(5, 201, 5).select(F.col("id").cast("int").alias("threshold"))
    return summary.crossJoin(F.broadcast(steps)).select(*by, "threshold", F.coalesce((F.col("effective_match") >= F.col("threshold")) & (F.col("least_match") >= floor), F.lit(False)).alias("publish"))


def inflation(calendar: DataFrame) -> DataFrame:
    """Cumulative inflation at each period of ``calendar`` (ord, deflator) against its first; null if either is null."""
    base = calendar.agg(F.min_by("deflator", "ord").alias("base"))
    return calendar.crossJoin(F.broadcast(base)).select("ord", (F.try_divide(F.col("deflator"), F.col("base")) - 1).alias("inflation"))


def real_change(nominal: Column, inflation: Column) -> Column:
    """Null with the nominal change."""
    return F.when(nominal.isNotNull(), F.try_divide(1 + nominal, 1 + inflation) - 1)


def real_index(index: DataFrame, calendar: DataFrame) -> DataFrame:
    """``index`` with the deflator's index (base 100) and the deflated index; blank where inflation is."""
    level = inflation(calendar)
    return index.join(level, "ord", "left").withColumn("deflator_index", (1 + F.col("inflation")) * 100).withColumn("real_index", F.try_divide(F.col("index"), 1 + F.col("inflation")))
