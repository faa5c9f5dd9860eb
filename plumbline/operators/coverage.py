"""How much of the panel a comparison uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import cuts

LEVELS = {"outlet": ("outlet",), "chain": ("chain",), "municipality": ("state", "municipality"), "state": ("state",)}


def coverage(links: DataFrame, cells: DataFrame, outlets: DataFrame | None = None) -> DataFrame:
    """Per level: entities observed and matched, and the median over links of matched by observed.

    Both inputs carry outlet, chain, state, municipality, and the links' outlets are among the cells'. A null attribute isn't
    an entity at its own level. Entities are bits of bitmaps by period, merged for the totals; rows are read once. ``outlets``
    is the dimension that the attributes come from, if there is one: else entities are found in the cells first.
    """
    numbers = cuts.entity_numbers(cells if outlets is None else outlets, LEVELS)
    seen, used = cuts.entity_bitmaps(cells, numbers, LEVELS), cuts.entity_bitmaps(links, numbers, LEVELS)
    of = lambda bitmaps, by, name: cuts.merged(bitmaps, by).withColumnRenamed("n", name)
    share = of(used, ["ord"], "matched").join(of(seen, ["ord"], "observed"), ["ord", "level"]).groupBy("level").agg(F.median(F.col("matched") / F.col("observed")).alias("coverage"))
    return of(seen, [], "observed").join(of(used, [], "matched"), "level").join(share, "level").select("level", "observed", "matched", "coverage")


def full_panel_outlets(cells: DataFrame) -> DataFrame:
    """Number of outlets seen in every period."""
    per_outlet = cells.groupBy("outlet").agg(F.count_distinct("ord").alias("periods"))
    total = cells.agg(F.count_distinct("ord").alias("total"))
    return per_outlet.crossJoin(F.broadcast(total)).agg(F.count_if(F.col("periods") == F.col("total")).alias("outlets"), F.max("total").alias("periods"))
