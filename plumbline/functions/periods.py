"""Half-month periods: labels ``yyyy-MM_q1`` and ``yyyy-MM_q2``, their ordinals and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PATTERN = r"^\d{4}-(0[1-9]|1[0-2])_q[12]$"
CPI_PATTERN = r"^\d{4}/(0[1-9]|1[0-2])/0[12]$"


def label_of(date: Column) -> Column:
    """Days 1 to 15 are the first half of a month, the rest the second."""
    return F.concat(F.date_format(date, "yyyy-MM"), F.when(F.dayofmonth(date) > 15, "_q2").otherwise("_q1"))


def ordinal_of_date(date: Column) -> Column:
    """24 per year, so consecutive periods differ by 1."""
    return F.year(date) * 24 + (F.month(date) - 1) * 2 + (F.dayofmonth(date) > 15).cast("int")


def start(label: Column) -> Column:
    """The first day of a half: the month's first, or as many days later as a first half has."""
    return F.date_add(F.to_date(F.left(label, F.lit(7)), "yyyy-MM"), (F.right(label, F.lit(1)).cast("int") - 1) * 15)


def ordinal(label: Column) -> Column:
    """The ordinal of the period's first day."""
    return ordinal_of_date(start(label))


def label_of_cpi(period: Column) -> Column:
    """``yyyy/MM/0n``: the third field is the half of the month, not a day. Null for anything else."""
    return F.when(period.rlike(CPI_PATTERN), F.regexp_replace(period, "^([0-9]+)/([0-9]+)/0", "$1-$2_q"))


def label_of_ordinal(number: Column) -> Column:
    year = F.floor(number / 24).cast("int")
    month = F.floor((number - year * 24) / 2).cast("int") + 1
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("_q"), (number % 2 + 1).cast("int").cast("string"))


def between(spark: SparkSession, first_month: str, last_month: str) -> DataFrame:
    """``(label)`` of every half-month from ``yyyy-MM`` to ``yyyy-MM``, both included."""
    ends = F.to_date(F.lit(f"{first_month}-01")), F.to_date(F.lit(f"{last_month}-01"))
    months = spark.range(1).select(F.explode(F.sequence(*ends, F.expr("interval 1 month"))).alias("month"))
    return months.select(F.explode(F.array(F.lit("_q1"), F.lit("_q2"))).alias("half"), "month").select(F.concat(F.date_format("month", "yyyy-MM"), "half").alias("label"))


def month_start(year: Column, month: Column) -> Column:
    """A month's first day, from numbers or their text."""
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
