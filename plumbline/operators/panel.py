"""Panels, their cells and the matched links between consecutive periods."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.keys import key
from plumbline.functions.numbers import log_relative


@dataclass(frozen=True)
class PanelSpec:
    """Which columns of a feed say who (outlet), what (item), when (period ordinal), how much, and which attempt."""

    outlet: tuple[str, ...] = ("outlet",)
    item: tuple[str, ...] = ("item",)
    ord: str = "ord"
    price: str = "price"
    attempt: str | None = None
    keep: tuple[str, ...] = field(default=())

    def of(self, feed: DataFrame) -> DataFrame:
        """The feed with columns outlet, item, ord, price, attempt; keys of several columns are hashed."""
        one = lambda names: F.col(names[0]) if len(names) == 1 else key(*names)
        attempt = F.col(self.attempt) if self.attempt else F.lit(1)
        return feed.select(one(self.outlet).alias("outlet"), one(self.item).alias("item"), F.col(self.ord).alias("ord"), F.col(self.price).alias("price"), attempt.cast("long").alias("attempt"), *self.keep)


def cells(panel: DataFrame) -> DataFrame:
    """One row per outlet, item and period: mean price (four decimals), count, least, greatest, last attempt."""
    return panel.groupBy("outlet", "item", "ord").agg(
        F.avg("price").cast("decimal(10,4)").alias("price"), F.count("price").alias("observations"), F.min("price").alias("price_min"), F.max("price").alias("price_max"), F.max("attempt").alias("attempt")
    )


def links(cells: DataFrame) -> DataFrame:
    """``(outlet, item, ord, log_rel)`` where a cell's outlet and item also have the period before.

    One shuffle on (outlet, item). Outlets may come and go; the first period has no link; prices that
    aren't positive are left to the gates and give a null relative here, which no measure counts.
    """
    line = Window.partitionBy("outlet", "item").orderBy("ord")
    before = cells.select("outlet", "item", "ord", "price", F.lag("ord").over(line).alias("ord_before"), F.lag("price").over(line).alias("price_before"))
    return before.filter(F.col("ord_before") == F.col("ord") - 1).select("outlet", "item", "ord", log_relative(F.col("price"), F.col("price_before")).alias("log_rel"))


def links_by_join(cells: DataFrame) -> DataFrame:
    """The same links as an equality self-join: the test twin of ``links``."""
    before = cells.select("outlet", "item", (F.col("ord") + 1).alias("ord"), F.col("price").alias("price_before"))
    return cells.join(before, ["outlet", "item", "ord"]).select("outlet", "item", "ord", log_relative(F.col("price"), F.col("price_before")).alias("log_rel"))


def links_of_batch(cells: DataFrame, batch: list[int], with_successors: bool = True) -> DataFrame:
    """Links that a changed batch of periods touches, read from the batch and its neighbours alone.

    A changed price moves the link into its own period and the one into the next, so both are made
    unless ``with_successors`` is off.
    """
    wanted = sorted({o for b in batch for o in ((b, b + 1) if with_successors else (b,))})
    needed = sorted({o for w in wanted for o in (w - 1, w)})
    return links(cells.filter(F.col("ord").isin(needed))).filter(F.col("ord").isin(wanted))


def star(rows: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Rows with a dimension's attributes; rows without a member stay, with null attributes."""
    return rows.join(dimension, on, "left")


def members(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose members are known: a slicer that leaves out the blank member of each dimension column."""
    return rows.dropna(subset=columns) if columns else rows


def mapped(column: Column, values: dict) -> Column:
    """Dictionary value, null for what the dictionary doesn't have."""
    out = F.lit(None)
    for k, v in values.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def by_mapping(rows: DataFrame, mapping: DataFrame, on: str) -> DataFrame:
    """As ``mapped`` for a dictionary held as a table."""
    return rows.join(mapping, on, "left")
