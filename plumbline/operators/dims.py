"""Dimension and calendar builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import periods
from plumbline.functions.keys import key
from plumbline.functions.text import grams, pieces

OPEN_END = "9999-12-31"


def collapse(df: DataFrame, natural: list[str], attributes: list[str], name: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """One row per natural key with its surrogate key ``name``; attributes must have passed the one-value gate."""
    one = df.groupBy(*natural).agg(*(F.max(a).alias(a) for a in attributes))
    return one.select(key(*natural).alias(name), *natural, *attributes).withColumns(derived or {})


def outlets(df: DataFrame, natural: list[str], attributes: list[str], channels: DataFrame | None = None, kind: str = "kind") -> DataFrame:
    """Outlet dimension of the full feed; ``channels`` (kind, channel) adds a channel, null where unmapped."""
    dim = collapse(df, natural, attributes, "outlet_id")
    return dim if channels is None else dim.join(channels, kind, "left")


def items(df: DataFrame, natural: list[str], attributes: list[str], text: str, names: DataFrame | None = None) -> DataFrame:
    """Item dimension with pieces and grams parsed from ``text``; ``names`` (text, name) adds a display name."""
    dim = collapse(df, natural, attributes, "item_id", {"pieces": pieces(F.col(text)), "grams": grams(F.col(text))})
    return dim if names is None else dim.join(names, text, "left")


def half_months(labels: DataFrame, deflator: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Period calendar of distinct labels: key, start, ordinal, year, month, deflator, month start if that month is known."""
    label = F.col("label")
    rows = labels.select("label").distinct().select(key("label").alias("period_id"), "label", periods.start(label).alias("start"), periods.ordinal(label).alias("ord"))
    rows = rows.withColumns({"year": F.year("start"), "month": F.month("start"), "month_start": F.trunc("start", "month")}).join(deflator, "label", "left")
    if months is None:
        return rows
    known = months.select(F.col("month_start").alias("known_month")).distinct()
    return rows.join(known, F.col("month_start") == F.col("known_month"), "left").drop("month_start").withColumnRenamed("known_month", "month_start")


def months(dates: DataFrame) -> DataFrame:
    """Month calendar of distinct dates (date): key, start, year, month, months since year 0."""
    rows = dates.select(F.trunc("date", "month").alias("month_start")).filter("month_start is not null").distinct()
    rows = rows.withColumns({"year": F.year("month_start"), "month": F.month("month_start")})
    return rows.select(key("year", "month").alias("month_id"), "month_start", "year", "month", (F.col("year") * 12 + F.col("month") - 1).alias("month_number"))


def map_key(dim: DataFrame, places: list[str], name: str = "map_key") -> DataFrame:
    """``dim`` with the text by which a map finds a place: its parts from the narrowest on, blanks left out; null without any."""
    parts = F.filter(F.array(*(F.trim(F.col(p).cast("string")) for p in places)), lambda x: x.isNotNull() & (x != ""))
    return dim.withColumn(name, F.when(F.size(parts) > 0, F.array_join(parts, ", ")))


def validity(table: DataFrame) -> DataFrame:
    """``(valid_from, valid_to)``: each distinct start ends the day before the next one, the last is open.

    The close is global: a new edition of the whole table ends every row of the one before. The
    window runs over distinct dates alone.
    """
    line = Window.orderBy("valid_from")
    return table.select("valid_from").distinct().withColumn("valid_to", F.coalesce(F.date_sub(F.lead("valid_from").over(line), 1), F.lit(OPEN_END).cast("date")))


def versioned(table: DataFrame, aliases: dict[str, str] | None = None, zone: str = "zone") -> DataFrame:
    """``table`` (zone, valid_from, ...) with valid_to and is_current; aliased zones keep their literal."""
    name = F.col(zone)
    for old, new in (aliases or {}).items():
        name = F.when(F.col(zone) == old, F.lit(new)).otherwise(name)
    rows = table.withColumn("zone_literal", F.col(zone)).withColumn(zone, name)
    return rows.join(validity(rows), "valid_from").withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END).cast("date"))


def valid_at(rows: DataFrame, dim: DataFrame, on: str, date: str) -> DataFrame:
    """Rows with the version of ``dim`` that holds on their date."""
    return rows.join(dim, (rows[on] == dim[on]) & rows[date].between(dim["valid_from"], dim["valid_to"]), "left").drop(dim[on])


def monthly_wages(df: DataFrame) -> DataFrame:
    """Wage fact from text columns year, month, nominal, real, index; a bad number raises."""
    start = periods.month_start(F.col("year"), F.col("month"))
    return df.select(key("year", "month").alias("month_id"), start.alias("month_start"), F.col("year").cast("int"), F.col("month").cast("int"), F.col("nominal").cast("decimal(10,4)"), F.col("real").cast("decimal(10,2)"), F.col("index").cast("decimal(10,2)"))


def half_monthly_cpi(df: DataFrame) -> DataFrame:
    """CPI fact from observations (period ``yyyy/MM/0n``, value text)."""
    label = periods.label_of_cpi(F.col("period"))
    return df.select(label.alias("label"), F.col("value").cast("decimal(12,6)").alias("deflator")).select(key("label").alias("period_id"), "label", "deflator")
