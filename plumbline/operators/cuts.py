"""One scan for a measure at several cuts at once: grouping sets over links, bitmaps of outlets, one running window.

Outlets get dense numbers; the distinct ones of a group are then the set bits of a few bitmaps of 32,768 bits each, which
merge upward by ``or`` instead of being counted again from rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.index import FLOOR, THRESHOLD, publishable

TOTAL = "total"


def dense(values: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct ``by`` tuples with ``name``, numbers from 1 without large gaps; in an order that depends on the values alone.

    Tuples with a null are left out. Values are dealt by hash to 1,024 slots, numbered within their slot, and each slot starts
    where the ones before it end: one small row a slot crosses tasks, and no task sorts all.
    """
    rows = values.select(*by).dropna().distinct().withColumn("_slot", F.pmod(F.xxhash64(*by), F.lit(1024)))
    sizes = rows.groupBy("_slot").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_slot").orderBy(*by))
    return rows.withColumn("_place", place).join(F.broadcast(sizes.select("_slot", before.alias("_before"))), "_slot").select(*by, (F.col("_place") + F.col("_before")).alias(name))


def _set_of(names: Sequence[str]) -> Column:
    """Name of the grouping set a row is of: the one column that isn't rolled up, or the total."""
    out = F.lit(TOTAL)
    for n in names:
        out = F.when(F.grouping(n) == 0, F.lit(n)).otherwise(out)
    return out


def _grouped(rows: DataFrame, cuts: Sequence[str], keep: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """``rows`` aggregated at each cut and in total, by ``keep`` as well: cut, value (text), keep, aggregates."""
    sets = [[F.col(k) for k in keep] + [F.col(c)] for c in cuts] + [[F.col(k) for k in keep]]
    value = F.coalesce(*(F.col(c).cast("string") for c in cuts)) if cuts else F.lit(None).cast("string")
    out = rows.groupingSets(sets, *keep, *cuts).agg(_set_of(cuts).alias("cut"), *aggregates)
    return out.select("cut", value.alias("value"), *keep, *(F.col(a) for a in out.columns if a not in {*keep, *cuts, "cut"}))


def per_period(links: DataFrame, numbers: DataFrame | None, cuts: Sequence[str]) -> DataFrame:
    """``(cut, value, ord, mean_rel, matched)``: as ``index.per_period``, at each cut and in total, from one pass over the links.

    ``links`` has outlet, ord, log_rel and the cut columns, ``numbers`` (outlet, number); without it, ``links`` has number. A null relative is no link: neither it
    nor its outlet counts. A null value of a cut is a group of its own.
    """
    known = links.filter(F.col("log_rel").isNotNull())
    known = known.filter(F.col("number").isNotNull()) if numbers is None else known.join(numbers, "outlet")
    rows = known.select("ord", *cuts, "log_rel", F.bitmap_bucket_number("number").alias("_bucket"), F.bitmap_bit_position("number").alias("_bit"))
    pieces = _grouped(rows, cuts, ["ord", "_bucket"], [F.sum("log_rel").alias("total"), F.count("*").alias("n"), F.bitmap_count(F.bitmap_construct_agg("_bit")).alias("outlets")])
    return pieces.groupBy("cut", "value", "ord").agg((F.sum("total") / F.sum("n")).alias("mean_rel"), F.sum("outlets").alias("matched"))


def presence(cells: DataFrame, cuts: Sequence[str]) -> DataFrame:
    """``(cut, value, ord, n)``: cells of every group of every cut and of the total in each period."""
    return _grouped(cells, cuts, ["ord"], [F.count("*").alias("n")])


def indices_of(stats: DataFrame, seen: DataFrame, threshold: float = THRESHOLD, floor: int = FLOOR) -> DataFrame:
    """``(cut, value, ord, matched, index)`` from ``per_period`` and ``presence``; a row a group and period, whatever the panel's size.

    Same rules as ``index.chained_index`` for each group: base 100 where it has a price at the calendar's first period, flat
    through a period without a link, null where the links from the base to there fail the guard. One running window
    serves all groups. The calendar is the periods seen.
    """
    calendar = seen.select("ord").distinct()
    base = calendar.agg(F.min("ord").alias("base"))
    priced = F.max((F.col("ord") == F.col("base")).cast("int"))
    groups = seen.crossJoin(F.broadcast(base)).groupBy("cut", "value").agg(priced.alias("priced"), F.max("base").alias("base"))
    grid = groups.crossJoin(F.broadcast(calendar))
    right = stats.select(F.col("cut").alias("_cut"), F.col("value").alias("_value"), F.col("ord").alias("_ord"), "mean_rel", "matched")
    rows = grid.join(right, (F.col("cut") == F.col("_cut")) & F.col("value").eqNullSafe(F.col("_value")) & (F.col("ord") == F.col("_ord")), "left")
    line = Window.partitionBy("cut", "value").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    effective = F.count("matched").over(line) / F.sum(1 / F.col("matched")).over(line)
    ok = publishable(effective, F.min("matched").over(line), threshold, floor)
    level = F.exp(F.sum("mean_rel").over(line)) * 100
    index = F.when(F.col("ord") == F.col("base"), F.when(F.col("priced") == 1, F.lit(100.0))).otherwise(F.when(ok, level))
    return rows.select("cut", "value", "ord", "matched", index.alias("index"))


def chained_indices(links: DataFrame, cells: DataFrame, numbers: DataFrame, cuts: Sequence[str], threshold: float = THRESHOLD, floor: int = FLOOR) -> DataFrame:
    """``(cut, value, ord, matched, index)``: the chained index of every group of every cut and of the total, see ``indices_of``."""
    return indices_of(per_period(links, numbers, cuts), presence(cells, cuts), threshold, floor)


def entity_numbers(entities: DataFrame, levels: dict[str, tuple[str, ...]]) -> DataFrame:
    """Distinct tuples of the levels' columns with a dense number for each level, null where an attribute is."""
    columns = list(dict.fromkeys(c for names in levels.values() for c in names))
    out = entities.select(*columns).distinct()
    for level, names in levels.items():
        out = out.join(dense(entities, names, f"_{level}"), list(names), "left")
    return out.select(*columns, *(f"_{n}" for n in levels))


def entity_bitmaps(rows: DataFrame, numbers: DataFrame, levels: dict[str, tuple[str, ...]]) -> DataFrame:
    """``(ord, level, bucket, bits)``: which entities of each level a period has; ``numbers`` from ``entity_numbers``.

    A tuple gives one bit a level in each period; bitmaps are made where the tuples are, and only they go on. An entity with a
    null attribute has no number and no bit.
    """
    columns = [c for c in numbers.columns if not c.startswith("_")]
    named = numbers.select(*(F.col(c).alias(f"_of_{c}") for c in columns), *(f"_{n}" for n in levels))
    joined = rows.select("ord", *columns).distinct().join(named, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
    bits = F.inline(F.array(*(F.struct(F.lit(n).alias("level"), F.col(f"_{n}").alias("number")) for n in levels)))
    marked = joined.select("ord", bits).filter("number is not null")
    return marked.groupBy("ord", "level", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of entities of each level, from bitmaps merged over all periods that share ``by``."""
    return bitmaps.groupBy(*by, "level", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).groupBy(*by, "level").agg(F.sum("n").alias("n"))
