"""Mixing sources to target weights by nested hash-threshold histograms, without a sort of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import maybe_broadcast, written

WORD = r"[^\x20\x09-\x0D]+"
#: The hash is the first 60 bits of md5, read 12 bits a level.
DIGITS, LEVELS = 3, 5
SPAN = 16 ** (DIGITS * LEVELS)


def words(text: Column) -> Column:
    """Number of words; null counts as an empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column) -> Column:
    """A document's fixed place in [0, 2^60): the same on every run and partitioning."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, DIGITS * LEVELS), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """``(source, source_size, target)``: ``share`` of all words dealt by weight, at most ``most`` times a source.

    Sources stand in code-point order, null last, and take the weights in turn. What a full source
    leaves is dealt again by weight until none is above its limit: in order of limit over weight,
    the first source that its share doesn't fill fixes the level for the rest. One row a source.
    """
    own = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = own.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    line = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = line.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = weighed.withColumn("level", level)
    open_level = F.max(F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("level"))).over(every)
    return leveled.select("source", "source_size", F.least("limit", F.coalesce(open_level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def thresholds(sizes: DataFrame, **kind) -> DataFrame:
    """``(source, source_size, target, times, below)``: every document is taken ``times`` and once more if its draw is under ``below``.

    ``sizes`` has source, size, place. Each level sums sizes by source and the next 12 bits of the
    draw, finds the bucket in which the budget runs out, and goes on inside that bucket alone. The
    last bucket, documents of one draw, is taken if that comes nearer to the budget than leaving it.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    dealt = written(targets(sizes, **kind).withColumn("times", whole).withColumn("need", F.col("target") - F.col("times") * F.col("source_size")), "targets")
    held = maybe_broadcast(dealt.select(F.col("source").alias("of"), "need"))
    rows = sizes.join(held, F.col("source").eqNullSafe(F.col("of"))).select("source", "need", "size", "place")
    state = None
    for level in range(LEVELS):
        step = 16 ** (DIGITS * (LEVELS - level - 1))
        if state is not None:
            state = maybe_broadcast(written(state, "boundary").select(F.col("source").alias("of"), "need", "start"))
            rows = sizes.join(state, F.col("source").eqNullSafe(F.col("of")) & (F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + step * 16**DIGITS)).select("source", "need", "size", "place")
        sums = rows.groupBy("source", "need", (F.col("place") - F.col("place") % step).alias("start")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("start"))
        cut = sums.withColumn("upto", upto).filter((F.col("upto") >= F.col("need")) & (F.col("need") > 0))
        state = cut.groupBy("source").agg(F.min_by(F.struct("start", "words", (F.col("need") - F.col("upto") + F.col("words")).alias("need")), "start").alias("x")).select("source", "x.*")
    nearer = F.col("words") - F.col("need") < F.col("need")
    last = state.select(F.col("source").alias("of"), (F.col("start") + nearer.cast("long")).alias("cut"))
    every = F.when(F.col("need") > 0, F.lit(SPAN)).otherwise(F.lit(0)).cast("long")
    return dealt.join(last, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "source_size", "target", "times", F.coalesce("cut", every).alias("below"))


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", words(F.col("text"))).withColumn("place", draw(F.col("doc_id")))


def mix(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source, size, place) with source_size, target, repeats and taken of the plan of ``thresholds``."""
    by = maybe_broadcast(plan.withColumnRenamed("source", "of"))
    repeats = F.col("times") + (F.col("place") < F.col("below")).cast("long")
    joined = rows.join(by, F.col("source").eqNullSafe(F.col("of"))).withColumn("repeats", repeats)
    return joined.withColumn("taken", F.col("size") * F.col("repeats")).drop("of", "times", "below")


def mix_sizes(docs: DataFrame, **kind) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of ``docs``.

    Null texts have size 0 and null sources are one source, last in order. Rows of one doc_id share
    a draw and are taken or left together. A source without words has target 0; an empty table
    gives an empty table. Extra columns are ignored.
    """
    rows = written(sized(docs.select(F.col("doc_id").cast("long"), "text", "source")).drop("text"), "sizes")
    plan = written(thresholds(rows, **kind), "mix")
    return mix(rows, plan).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **kind) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the same columns, whatever their names.

    Null texts have no words and are taken as often as the whole source is; rows of one doc_id go together, repeated rows stay
    rows, and an empty table gives an empty table.
    """
    rows = written(sized(docs.select(F.col("doc_id").cast("long"), "text", "source")).drop("text"), "sizes")
    plan = written(thresholds(rows, **kind), "mix")
    inner = sized(docs.select(F.struct(*(F.col(f"`{n}`") for n in docs.columns)).alias("row"), F.col("doc_id").cast("long"), "text", "source")).drop("text")
    taken = mix(inner, plan).filter("repeats > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select("row.*")
