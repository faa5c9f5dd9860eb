"""Quality gates: each gives the rows that break a rule, and ``enforce`` stops a run on the first of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.text import first_illegal, is_illegal


class GateError(RuntimeError):
    """A gate found violations; the message holds a bounded sample."""


def enforce(violations: DataFrame, name: str, sample: int = 10) -> None:
    """Raise if there is any row, showing at most ``sample``. A sound table costs one limited job."""
    rows = violations.limit(sample).collect()
    if rows:
        raise GateError(f"{name}: " + "; ".join(str(r.asDict(recursive=True)) for r in rows))


def enforce_each(df: DataFrame, bad: Column, gates: dict[str, DataFrame]) -> None:
    """``enforce`` of several gates on rules that a row breaks by itself: ``bad`` is a row that breaks any, and only if there is one each gate is asked."""
    if df.filter(bad).limit(1).collect():
        for name, violations in gates.items():
            enforce(violations, name)


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def is_malformed(column: str, pattern: str) -> Column:
    return ~F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def blank_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, blanks)`` of the columns that have a null or blank value, from one pass."""
    wide = df.agg(*(F.count_if(is_blank(c)).alias(f"c{i}") for i, c in enumerate(columns)))
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) as (column, blanks)").filter("blanks > 0")


def _offending(df: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Rows of the keys under which an attribute has more than one value; one aggregate of two numbers per attribute finds the keys."""
    ends = df.groupBy(*keys).agg(*(f(F.col(a).cast("string")).alias(f"{n}{i}") for i, a in enumerate(attributes) for n, f in (("low", F.min), ("high", F.max))))
    several = F.lit(False)
    for i in range(len(attributes)):
        several = several | F.coalesce(F.col(f"low{i}") < F.col(f"high{i}"), F.lit(False))
    bad = ends.filter(several).select(*(F.col(k).alias(f"bad_{k}") for k in keys))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"bad_{k}"))
    return df.join(bad, on, "left_semi")


def several_values(df: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Keys with more than one distinct value of an attribute: ``(keys, attribute, values)``. Values are gathered for such keys alone."""
    sets = _offending(df, keys, attributes).groupBy(*keys).agg(*(F.sort_array(F.collect_set(F.col(a).cast("string"))).alias(f"values{i}") for i, a in enumerate(attributes)))
    each = F.explode(F.array(*(F.struct(F.lit(a).alias("attribute"), F.col(f"values{i}").alias("values")) for i, a in enumerate(attributes))))
    return sets.select(*keys, each.alias("x")).select(*keys, "x.attribute", "x.values").filter(F.size("values") > 1)


def conflicting_rows(df: DataFrame, keys: list[str], attribute: str) -> DataFrame:
    """The rows behind ``several_values``: evidence of which records disagree."""
    return _offending(df, keys, [attribute])


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, count)`` of keys that stand for more than one row."""
    return df.groupBy(key).count().filter("count > 1")


def broken(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``(rule, violations)`` of the named predicates that a row fails; unknown counts as failed."""
    wide = df.agg(*(F.count_if(~F.coalesce(F.expr(r), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules.values())))
    pairs = ", ".join(f"'{n}', r{i}" for i, n in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)").filter("violations > 0")


def illegal_characters(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``(keys, column, character, code)`` of the first character outside the allowed set, per row and column."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns))
    rows = df.select(*keys, F.explode(cells).alias("x")).filter(is_illegal(F.col("x.value")))
    return rows.select(*keys, "x.column", first_illegal(F.col("x.value")).alias("character")).withColumn("code", F.ascii("character"))


def unknown_format(df: DataFrame, column: str, patterns: list[str]) -> DataFrame:
    """Distinct values that match none of the patterns."""
    known = F.lit(False)
    for p in patterns:
        known = known | F.col(column).rlike(p)
    return df.select(column).distinct().filter(~F.coalesce(known, F.lit(False)))


def too_many(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``(n)`` if there are more than ``most`` distinct keys."""
    return df.agg(F.count_distinct(*keys).alias("n")).filter(F.col("n") > most)


def outside_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """Distinct values, null included, that a one-column vocabulary doesn't have."""
    known = vocabulary.toDF("known")
    return df.select(column).distinct().join(known, F.col(column) == F.col("known"), "left_anti")


def reachable(dim: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Rows of a dimension that some fact refers to: the scope of a vocabulary gate."""
    return dim.join(facts.select(key).distinct(), key, "left_semi")


def uncovered(df: DataFrame, column: str) -> DataFrame:
    """Rows that a mandatory left join left without a value."""
    return df.filter(F.col(column).isNull())


def calendar_gaps(calendar: DataFrame) -> DataFrame:
    """``(ord, next_ord)`` around each hole of a calendar; the window runs over distinct periods alone."""
    line = Window.orderBy("ord")
    return calendar.select("ord").distinct().withColumn("next_ord", F.lead("ord").over(line)).filter(F.col("next_ord") - F.col("ord") != 1)


def validity_gaps(dim: DataFrame, key: str) -> DataFrame:
    """``(key, valid_to, next_from)`` where a version doesn't end the day before the next begins."""
    line = Window.partitionBy(key).orderBy("valid_from")
    rows = dim.withColumn("next_from", F.lead("valid_from").over(line))
    return rows.filter(F.col("next_from").isNotNull() & (F.col("valid_to") != F.date_sub("next_from", 1))).select(key, "valid_to", "next_from")


def other_series(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Distinct combinations of identifying columns other than the expected one."""
    same = F.lit(True)
    for c, v in expected.items():
        same = same & F.col(c).eqNullSafe(F.lit(v))
    return df.select(*expected).distinct().filter(~same)


def malformed(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.select(column).distinct().filter(is_malformed(column, pattern))


def lost_accents(df: DataFrame, columns: list[str]) -> DataFrame:
    """Measure, not a gate: rows with a question mark in any of the columns."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).contains("?"), F.lit(False))
    return df.agg(F.count_if(hit).alias("rows"))


def unknown_periods(spark: SparkSession, asked: list[str], known: DataFrame) -> DataFrame:
    """Asked labels that the known ones (label) don't have."""
    rows = spark.createDataFrame([(a,) for a in asked], "label string")
    return rows.join(known.select("label").distinct(), "label", "left_anti")
