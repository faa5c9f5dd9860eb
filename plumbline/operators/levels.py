"""Price levels: means, dispersion, opening and closing prices, histograms, purchasing power."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import selection


def price_levels(cells: DataFrame, by: list[str], least_outlets: int = 0) -> DataFrame:
    """Mean and median cell price, ratio of the 90th to the 10th percentile, observed outlets.

    ``least_outlets`` leaves out groups seen in fewer outlets. Prices are decimals of four digits, as ``panel.cells`` makes them;
    percentiles are exact, selected from counts of equal prices.
    """
    price = F.col("price").cast("double")
    whole = cells.groupBy(*by).agg(F.avg(price).alias("mean_price"), F.count_distinct("outlet").alias("outlets")).filter(F.col("outlets") >= least_outlets)
    shares = selection.percentiles(selection.value_counts(cells, by, "price"), by, {"_p10": 0.1, "median_price": 0.5, "_p90": 0.9})
    named = shares.select(*(F.col(c).alias(f"_{c}") for c in by), "_p10", "median_price", "_p90")
    rows = whole.join(named, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left") if by else whole.join(F.broadcast(named), F.lit(True), "left")
    return rows.select(*by, "mean_price", "median_price", F.try_divide("_p90", "_p10").alias("p90_p10"), "outlets")


def open_close(cells: DataFrame, by: list[str], least_outlets: int = 5) -> DataFrame:
    """Mean price at the selection's first and last period and outlets at both ends (the lesser count)."""
    ends = cells.agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    rows = cells.crossJoin(F.broadcast(ends))
    at_first, at_last = F.col("ord") == F.col("first"), F.col("ord") == F.col("last")
    price = F.col("price").cast("double")
    out = rows.filter(at_first | at_last).groupBy(*by).agg(
        F.avg(F.when(at_first, price)).alias("opening"), F.avg(F.when(at_last, price)).alias("closing"),
        F.least(F.count_distinct(F.when(at_first, F.col("outlet"))), F.count_distinct(F.when(at_last, F.col("outlet")))).alias("outlets"),
    )
    return out.filter(F.col("outlets") >= least_outlets)


def histogram(cells: DataFrame, first: float, last: float, width: float = 1.0) -> DataFrame:
    """Cells per bin ``[centre - width/2, centre + width/2)``; 0 inside the observed range, null outside it."""
    price = F.col("price").cast("double")
    place = F.floor((price - first) / width + 0.5)
    counted = cells.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    seen = cells.agg(F.min(price).alias("low"), F.max(price).alias("high"))
    n = int(round((last - first) / width)) + 1
    bins = cells.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"), (F.lit(float(first)) + F.col("id") * F.lit(float(width))).alias("centre"))
    half = width / 2
    inside = (F.col("centre") + half > F.col("low")) & (F.col("centre") - half <= F.col("high"))
    return bins.join(counted, "bin", "left").crossJoin(F.broadcast(seen)).select("bin", "centre", F.when(inside, F.coalesce("n", F.lit(0))).alias("cells"))


def daily_wage(wages: DataFrame, calendar: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean wage over the distinct months of the selected periods; ``wages`` (month, wage), ``calendar`` (ord, month)."""
    months = calendar.select(*(by or []), "month").distinct()
    return months.join(wages, "month").groupBy(*(by or [])).agg(F.avg("wage").alias("wage"))


def units_per_day(cells: DataFrame, calendar: DataFrame, wages: DataFrame) -> DataFrame:
    """How many units of the mean price a day's wage buys, per period; null where the wage is."""
    priced = cells.groupBy("ord").agg(F.avg(F.col("price").cast("double")).alias("mean_price"))
    rows = priced.join(calendar, "ord", "left").join(wages, "month", "left")
    return rows.select("ord", "mean_price", "wage", F.try_divide(F.col("wage"), F.col("mean_price")).alias("units"))


def units_at_ends(cells: DataFrame, calendar: DataFrame, wages: DataFrame) -> DataFrame:
    """One row: units per day at the selection's first period and at its last; null where the wage is."""
    units = units_per_day(cells, calendar, wages)
    return units.agg(F.min_by("units", "ord").alias("at_opening"), F.max_by("units", "ord").alias("at_close"))


def wage_index(calendar: DataFrame, wages: DataFrame) -> DataFrame:
    """Change of the wage against the first period's, and the index on base 100; null if either wage is."""
    rows = calendar.join(wages, "month", "left").select("ord", "wage")
    base = rows.agg(F.min_by("wage", "ord").alias("base"))
    change = F.try_divide(F.col("wage"), F.col("base")) - 1
    return rows.crossJoin(F.broadcast(base)).select("ord", change.alias("wage_change"), ((1 + change) * 100).alias("wage_index"))


def freshness(calendar: DataFrame) -> DataFrame:
    """Label of the last period."""
    return calendar.agg(F.max_by("label", "ord").alias("label"))
