"""An index kept up to date: sums of each period stored, those of changed periods replaced, the index added up from them.

The state has a row for each group of each cut and period, so its size doesn't follow the panel's. A run reads the cells of the
changed periods and their neighbours, whatever the history's length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import cuts
from plumbline.operators import panel as P
from plumbline.operators.index import FLOOR, THRESHOLD
from plumbline.sources import sinks


def refresh(path: str, cells: DataFrame, outlets: DataFrame, by: Sequence[str], changed: Sequence[int], links: DataFrame | None = None) -> None:
    """Bring the state below ``path`` to ``cells`` (outlet, item, ord, price) in the changed periods; a first call lists all.

    ``outlets`` (outlet, attributes) holds the columns of ``by`` that aren't the cells'. The links of a changed period and of the
    one after it are made anew, or read from ``links`` (outlet, item, ord, log_rel) if given. A changed period without cells any more
    loses its rows.
    """
    if not changed:
        return
    changed = sorted(set(changed))
    touched = sorted({o for c in changed for o in (c, c + 1)})
    members = sinks.kept(P.star(outlets, cuts.dense(outlets, ["outlet"], "number"), "outlet"), f"{path}/members")  # numbered once, in a query of its own
    made = P.links_of_batch(cells, changed) if links is None else links.filter(F.col("ord").isin(touched)).select("outlet", "item", "ord", "log_rel")
    sinks.replace_periods(cuts.per_period(P.star(made, members, "outlet"), None, by), f"{path}/stats", "ord", touched)
    seen = P.star(cells.filter(F.col("ord").isin(changed)), outlets, "outlet")
    sinks.replace_periods(cuts.presence(seen, by), f"{path}/seen", "ord", changed)


def read(spark: SparkSession, path: str, threshold: float = THRESHOLD, floor: int = FLOOR) -> DataFrame:
    """The index of every group of every cut, as ``cuts.chained_indices`` gives it for all cells, from the state alone."""
    stats, seen = (spark.read.parquet(f"{path}/{n}").withColumn("ord", F.col("ord").cast("int")) for n in ("stats", "seen"))
    return cuts.indices_of(stats, seen, threshold, floor)
