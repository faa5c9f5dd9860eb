"""The batch layers over a ``Store``: text as landed, gated cells and dimensions, links and intervals.

Each step assembles lazily, stops at a gate before anything is written, writes dimensions first and
the fact last. What is pending is derived from the fact, so a step that failed is simply run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import periods, text
from plumbline.functions.keys import key
from plumbline.operators import bootstrap, dims, gates, kept_index
from plumbline.operators import panel as P
from plumbline.sources import landing, sinks, state


#: Buckets of new dimensions and intervals: each of a few million members is still a small file, and an upsert costs by bucket.
SMALL = 8


@dataclass(frozen=True)
class FeedSpec:
    """A feed's natural keys, attributes, price, text repair and exclusions.

    ``outlet``, ``item`` and their ``_key`` columns are the star's own names: a feed that has them raises here.
    """

    outlet: tuple[str, ...]
    outlet_attributes: tuple[str, ...]
    item: tuple[str, ...]
    item_attributes: tuple[str, ...]
    price: str
    words: dict[str, str] = field(default_factory=dict)
    typos: dict[str, dict[str, str]] = field(default_factory=dict)
    excluded: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        taken = {"outlet", "item", "outlet_key", "item_key"} & {*self.outlet, *self.outlet_attributes, *self.item, *self.item_attributes}
        if taken:
            raise ValueError(f"columns named as the star's own: {sorted(taken)}")


def run_bronze(store: sinks.Store, table: str, paths: Sequence[str], manifest: DataFrame, run_id: str, log: sinks.RunLog) -> int:
    """Append the landed files of the batches that the table doesn't have; returns how many batches.

    ``manifest`` has file, period, attempt, sha256, rows; a file is named by its whole path or the end of it, as in ``parquet_landing``.
    A batch may have several files. The rows of each new batch must be those declared for all of its files.
    """
    path = store.path("bronze", table)
    have = store.read("bronze", table) if store.has("bronze", table) else None
    todo = state.pending(manifest, have, {"period": "_period", "attempt": "_attempt"})
    told = todo.collect()  # one row a file, compared with the table once
    todo = store.spark.createDataFrame(told, manifest.schema)
    names = {r.file.lstrip("/") for r in told}
    wanted = [p for p in paths if not names.isdisjoint(landing.endings(p))]
    if wanted:
        rows = landing.parquet_landing(store.spark, wanted, todo)
        expected = todo.groupBy(F.col("period").alias("_period"), F.col("attempt").alias("_attempt")).agg(F.sum("rows").alias("expected"))
        gates.enforce(state.unreconciled(rows, expected, ["_period", "_attempt"]), "rows read are not those declared")
        sinks.append(landing.audited(rows, run_id, {"_attempt": "bigint"}), path)
    batches = len({(r.period, r.attempt) for r in told}) if wanted else 0
    log.note(f"bronze.{table}", batches=batches, files=len(wanted))
    return batches


def run_silver(store: sinks.Store, table: str, spec: FeedSpec, asked: str, log: sinks.RunLog) -> list[str]:
    """Cells and dimensions of the pending or asked periods; returns the periods written."""
    landed = store.read("bronze", table)
    rows = state.current(landed, "_period", "_attempt")
    known = landed.groupBy(F.col("_period").alias("label")).agg(F.max("_attempt").alias("_attempt")).dropna()  # the batches that ``current`` keeps
    done = store.read("silver", "cells").select("label", "attempt") if store.has("silver", "cells") else None
    todo = state.selected(asked, state.pending(known, done, {"label": "label", "_attempt": "attempt"}), known)
    labels = sorted(r.label for r in todo.collect())
    if not labels:
        log.note(f"silver.{table}", periods=0)
        return []
    batch = state.without(rows.filter(F.col("_period").isin(labels)), spec.item[0], spec.excluded)
    batch = text.canonical(batch, [*spec.outlet, *spec.outlet_attributes], spec.words, spec.typos)
    batch = store.kept("silver", f"_{table}_batch", batch)  # repaired once, read by every gate and by the tables
    natural = [*spec.outlet, *spec.item]
    outlet = [*spec.outlet, *spec.outlet_attributes]
    bad = gates.is_malformed("_period", periods.PATTERN)
    for broken in (*(gates.is_blank(c) for c in (*natural, spec.price)), *(F.coalesce(text.is_illegal(F.col(c)), F.lit(False)) for c in outlet)):
        bad = bad | broken
    gates.enforce_each(batch, bad, {
        "period format": gates.malformed(batch, "_period", periods.PATTERN), "blank columns": gates.blank_counts(batch, [*natural, spec.price]),
        "illegal characters": gates.illegal_characters(batch, ["_period"], outlet),
    })
    if spec.item_attributes:
        gates.enforce(gates.several_values(batch, list(spec.item), list(spec.item_attributes)), "several values of an item")
    priced = batch.withColumns({spec.price: F.col(spec.price).cast("decimal(10,2)"), "ord": periods.ordinal(F.col("_period"))})
    panel = P.PanelSpec(outlet=spec.outlet, item=spec.item, price=spec.price, attempt="_attempt")
    cells = P.cells(panel.of(priced)).withColumn("label", periods.label_of_ordinal(F.col("ord")))
    cells = store.kept("silver", f"_{table}_cells", cells)  # made once, for the gate and the table
    gates.enforce(gates.broken(cells, {"positive price": "price_min > 0"}), "cell rules")
    one = lambda names: F.col(names[0]) if len(names) == 1 else key(*names)
    for name, nat, attributes in (("items", spec.item, spec.item_attributes), ("outlets", spec.outlet, spec.outlet_attributes)):
        dim = batch.groupBy(*nat).agg(*(F.max(a).alias(a) for a in attributes), F.count("*").alias("_n")).drop("_n").withColumn(f"{name[:-1]}_key", one(nat))
        if len(nat) > 1:  # a key of one column is that column, by which the rows are grouped
            gates.enforce(gates.repeated_keys(dim, f"{name[:-1]}_key"), f"{name}: one key for several members")
        log.note(f"silver.{table}.{name}", **sinks.upsert(dim, store.path("silver", name), list(nat), SMALL))
    sinks.replace_periods(cells, store.path("silver", "cells"), "label", labels)
    log.note(f"silver.{table}", periods=len(labels))
    return labels


def _replaced(store: sinks.Store, name: str, rows: DataFrame, labels: Sequence[str]) -> None:
    sinks.replace_periods(rows.withColumn("period_id", key("label")), store.path("gold", name), "label", labels)


def run_gold(store: sinks.Store, labels: Sequence[str], replicas: int, log: sinks.RunLog, cuts: Sequence[str] = (), deflator: DataFrame | None = None) -> None:
    """The star of the changed periods: dimensions, price facts, links, the index of each cut, and the interval over all links.

    Facts carry keys and measures only: period_id, outlet and item point to ``calendar``, ``outlets`` and ``items``, whose attributes
    stand once. Facts of a changed period, and the links and index sums that it touches, take the place of the old ones; dimensions
    are upserted by key. ``cuts`` names the columns (item, or attributes of outlets) by which the index is kept, besides its total;
    ``deflator`` (label, deflator) goes to the calendar.
    """
    if not labels:
        log.note("gold", links=0)
        return
    cells = store.read("silver", "cells")
    seen = cells.select("label", "ord").distinct()
    told = seen.collect()  # one row a period
    at = {r.label: r.ord for r in told}
    calendar = store.spark.createDataFrame(told, seen.schema)
    if at and max(at.values()) - min(at.values()) >= len(at):
        gates.enforce(gates.calendar_gaps(calendar), "calendar gap")
    changed = sorted(at[x] for x in labels if x in at)
    known = deflator if deflator is not None else store.spark.createDataFrame([], "label string, deflator double")
    dimensions = {"calendar": (dims.half_months(calendar, known), "period_id")}
    for name in ("outlets", "items"):
        member = name[:-1]
        dimensions[name] = store.read("silver", name).withColumnRenamed(f"{member}_key", member), member
    for name, (rows, own) in dimensions.items():
        log.note(f"gold.{name}", **sinks.upsert(rows, store.path("gold", name), [own], SMALL))
    facts = cells.filter(F.col("label").isin(list(labels))).select("outlet", "item", "price", "observations", "price_min", "price_max", "label")
    _replaced(store, "prices", facts, labels)
    prices = cells.select("outlet", "item", "ord", "price")
    links = P.links_of_batch(prices, changed).withColumn("label", periods.label_of_ordinal(F.col("ord")))
    touched = [x for x in at if at[x] in changed or at[x] - 1 in changed]
    _replaced(store, "links", links, touched)
    kept = store.read("gold", "links")
    whole = kept.select("outlet", "item", "ord", "log_rel")
    kept_index.refresh(store.path("gold", "index"), prices, dimensions["outlets"][0], list(cuts), changed, kept.filter(F.col("label").isin(touched)))
    interval = store.kept("gold", "_interval", bootstrap.interval(whole, replicas))  # made once, read for its items and its rows
    interval = bootstrap.filled(interval, calendar)
    log.note("gold", links=whole.count(), **sinks.upsert(interval, store.path("gold", "interval"), ["item", "ord"], SMALL))
