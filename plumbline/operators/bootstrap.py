"""Bootstrap interval of the chained index: outlets drawn with replacement, as products of matrices in blocks.

Draw number d of replica r of an item with n outlets takes the outlet number ``floor(h * n / 2^32)`` of its
roster, h being 32 bits mixed from (seed, item), r and d. No random state is shared, so the result doesn't depend on
partitioning, and nothing passes through the driver.

A slice of replicas of an item is one group: it counts its draws per outlet, then meets the item's links block by block of
outlets. A (replicas x outlets) matrix of counts times an (outlets x periods) matrix of the links' sums and counts is added to the
slice's own sums. What is shuffled is the links, once a slice: no draw, count or partial product. A task holds the counts of one
slice, of bounded size, and one block; or the level of all replicas of one item at every period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.package import ship

REPLICAS, SEED = 2000, 20240101

#: Outlets in a block, replicas in a slice, counts that a slice holds (it has fewer replicas of a larger roster), and draws made at a time.
OUTLETS, SLICE, COUNTS, DRAWS = 2048, 200, 1 << 26, 1 << 17


def hashed(*parts: Column) -> Column:
    """32 bits of md5 of the parts joined by a bar, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("long")


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit numbers that looks random: a linear step, a shift by its own high bits, a product; products wrap."""
    state = x * np.uint32(747796405) + np.uint32(2891336453)
    word = ((state >> ((state >> np.uint32(28)) + np.uint32(4))) ^ state) * np.uint32(277803737)
    return (word >> np.uint32(22)) ^ word


def mixed_draws(n: int) -> np.ndarray:
    return mixed(np.arange(n, dtype=np.uint32) + np.uint32(0x9E3779B9))


def draw_counts(stream: int, n: int, first: int, last: int, draws: np.ndarray | None = None) -> np.ndarray:
    """How often replicas ``first`` to ``last`` - 1 drew each of ``n`` outlets in ``n`` draws; ``stream`` is the item's own number."""
    replica = mixed((np.uint64(stream) + np.arange(first, last, dtype=np.uint64)).astype(np.uint32))
    draws = mixed_draws(n) if draws is None else draws
    counts = np.zeros((last - first) * n, np.int64)
    row = (np.arange(last - first) * n)[:, None]
    for start in range(0, n, DRAWS):
        place = (mixed(replica[:, None] ^ draws[start : start + DRAWS]).astype(np.uint64) * np.uint64(n)) >> np.uint64(32)
        counts += np.bincount((place.view(np.int64) + row).ravel(), minlength=len(counts))
    return counts.reshape(-1, n)


def slice_counts(stream: int, n: int, first: int, last: int) -> np.ndarray:
    """``draw_counts`` made some replicas at a time and held in one byte each, or in four where a replica drew an outlet more often."""
    draws, step = mixed_draws(n), max(1, DRAWS // n)
    out = np.empty((last - first, n), np.uint8)
    for a in range(first, last, step):
        some = draw_counts(stream, n, a, min(last, a + step), draws)
        if out.dtype == np.uint8 and some.max() > 255:
            out = out.astype(np.uint32)
        out[a - first : a - first + len(some)] = some
    return out


class _Sums:
    """Weighted sums and counts of the links of one slice's replicas, by period, added up over blocks of outlets."""

    def __init__(self, stream: int, n: int, first: int, last: int) -> None:
        self.counts, self.ords = slice_counts(stream, n, first, last), np.empty(0, np.int64)
        self.sums = np.zeros((2, last - first, 0))

    def add(self, block: int, place: np.ndarray, ord_: np.ndarray, total: np.ndarray, n: np.ndarray) -> None:
        counts = self.counts[:, block * OUTLETS : (block + 1) * OUTLETS].astype(np.float64)
        ords = np.unique(ord_)
        grown = np.union1d(self.ords, ords)
        if len(grown) > len(self.ords):
            sums = np.zeros((2, len(counts), len(grown)))
            sums[:, :, np.searchsorted(grown, self.ords)] = self.sums
            self.ords, self.sums = grown, sums
        at = np.searchsorted(self.ords, ords)
        for own, values in zip(self.sums, (total, n), strict=True):
            side = np.zeros((counts.shape[1], len(ords)))
            side[place, np.searchsorted(ords, ord_)] = values
            own[:, at] += counts @ side


def _blocks(links: DataFrame, seed: int) -> DataFrame:
    """``(item, n, stream, block, cells)``: size of the item's roster, its own number, and the links of a block of outlets, numbered within it."""
    # Sums and counts are taken per outlet first, as a weight multiplies both.
    own = links.filter("item is not null").groupBy("item", "outlet", "ord").agg(F.sum("log_rel").alias("total"), F.count("log_rel").cast("double").alias("n"))
    cell = F.struct(F.col("ord").cast("long").alias("ord"), F.coalesce("total", F.lit(0.0)).alias("total"), "n")
    rows = own.groupBy("item", "outlet").agg(F.collect_list(cell).alias("cells"))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy("outlet")) - 1)
    place = (F.col("place") % OUTLETS).cast("int").alias("place")
    cells = F.transform("cells", lambda c: F.struct(place, c["ord"].alias("ord"), c["total"].alias("total"), c["n"].alias("n")))
    block = F.floor(F.col("place") / OUTLETS).cast("int").alias("block")
    blocks = placed.filter("outlet is not null").select("item", block, cells.alias("cells")).groupBy("item", "block").agg(F.flatten(F.collect_list("cells")).alias("cells"))
    sizes = links.filter("item is not null").select("item", "outlet").distinct().groupBy("item").agg(F.count("*").alias("n"))
    return blocks.join(sizes.withColumn("stream", hashed(F.lit(seed), F.col("item"))), "item")


def _summed(links: DataFrame, replicas: int, seed: int) -> tuple[DataFrame, str]:
    """``(item, slice, ords, total, n)``: weighted sums and counts of links, replicas x periods as bytes; and the item's type."""
    spark, kind = links.sparkSession, dict(links.dtypes)["item"]
    ship(spark)
    most = F.greatest(F.lit(1), F.least(F.lit(SLICE), F.floor(F.lit(COUNTS) / F.col("n")))).cast("int")
    slices = F.explode(F.sequence(F.lit(0), F.floor(F.lit(replicas - 1) / F.col("most")).cast("int")))
    rows = _blocks(links, seed).withColumn("most", most).withColumn("slice", slices)
    # Work follows the draws, not the bytes: a given number of tasks, which Spark doesn't merge as it would merge small ones.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    rows = rows.repartition(tasks, "item", "slice").sortWithinPartitions("item", "slice", "block")
    shape = pa.schema([("slice", pa.int32()), ("ords", pa.list_(pa.int64())), ("total", pa.binary()), ("n", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, item, held = None, None, None

        def done() -> pa.RecordBatch:
            row = [{"slice": at[1], "ords": held.ords.tolist(), "total": held.sums[0].tobytes(), "n": held.sums[1].tobytes()}]
            own = pa.RecordBatch.from_pylist(row, shape)
            return pa.RecordBatch.from_arrays([item, *own.columns], names=["item", *shape.names])

        for batch in batches:
            told = batch.drop_columns(["cells"]).to_pylist()
            for i, r in enumerate(told):
                if at != (r["item"], r["slice"]):
                    if held is not None:
                        yield done()
                    first = r["slice"] * r["most"]
                    at, item, held = (r["item"], r["slice"]), batch.column("item").slice(i, 1), None
                    held = _Sums(r["stream"], r["n"], first, min(replicas, first + r["most"]))
                held.add(r["block"], *(c.to_numpy(zero_copy_only=False) for c in batch.column("cells").slice(i, 1).flatten().flatten()))
        if held is not None:
            yield done()

    return rows.mapInArrow(run, f"item {kind}, slice int, ords array<bigint>, total binary, n binary"), kind


def _levels(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Periods, and per replica and period the running sum of weighted means; not a number where a replica drew no outlet of a link."""
    ords = np.unique(np.concatenate([np.array(r["ords"], np.int64) for r in rows]))
    out = []
    for r in sorted(rows, key=lambda r: r["slice"]):
        at = np.searchsorted(ords, r["ords"])
        total, n = (np.frombuffer(r[c]).reshape(-1, len(r["ords"])) for c in ("total", "n"))
        mean = np.full((len(n), len(ords)), np.nan)
        mean[:, at] = np.where(n > 0, total / np.where(n > 0, n, 1), np.nan)
        out.append(np.where(np.isnan(mean), np.nan, np.nancumsum(mean, axis=1)))
    return ords, np.concatenate(out)


def interval(links: DataFrame, replicas: int = REPLICAS, seed: int = SEED, log: bool = False) -> DataFrame:
    """``(item, ord, low, high, error, replicas)``: exact 2.5 and 97.5 percentiles and sample deviation over replicas.

    ``links`` (item, outlet, ord, log_rel). A replica that drew no outlet of a link isn't counted at its period; a null
    relative counts as no link, though its outlet is in the roster. The deviation of one replica is null.
    """
    sums, kind = _summed(links, replicas, seed)

    def ends(key: tuple, table: pa.Table) -> pa.Table:
        ords, level = _levels(table.to_pylist())
        level = level if log else np.exp(level) * 100
        rows = []
        for place, column in zip(ords.tolist(), level.T, strict=True):
            seen = column[~np.isnan(column)]
            if len(seen):
                low, high = np.percentile(seen, [2.5, 97.5])
                rows.append({"ord": place, "low": float(low), "high": float(high), "error": float(seen.std(ddof=1)) if len(seen) > 1 else None, "replicas": len(seen)})
        made = pa.Table.from_pylist(rows, pa.schema([("ord", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("error", pa.float64()), ("replicas", pa.int64())]))
        item = table.column("item").combine_chunks().slice(0, 1)
        return made.add_column(0, "item", pa.concat_arrays([item] * len(rows)) if rows else item.slice(0, 0))

    made = sums.groupBy("item").applyInArrow(ends, f"item {kind}, ord bigint, low double, high double, error double, replicas bigint")
    return made.withColumn("ord", F.col("ord").cast(dict(links.dtypes)["ord"]))


def replicas_of(links: DataFrame, replicas: int = REPLICAS, seed: int = SEED) -> DataFrame:
    """``(item, replica, ord, log_index)``: the running sum of every replica, unfolded from the sums of ``interval``; a large table."""
    sums, kind = _summed(links, replicas, seed)

    def unfolded(key: tuple, table: pa.Table) -> pa.Table:
        ords, level = _levels(table.to_pylist())
        a, b = np.nonzero(~np.isnan(level))
        item = table.column("item").combine_chunks().slice(0, 1)
        return pa.table({"item": pa.concat_arrays([item] * len(a)) if len(a) else item.slice(0, 0), "replica": pa.array(a, pa.int32()), "ord": pa.array(ords[b], pa.int64()), "log_index": pa.array(level[a, b])})

    return sums.groupBy("item").applyInArrow(unfolded, f"item {kind}, replica int, ord bigint, log_index double")


def filled(interval: DataFrame, calendar: DataFrame, at_base: tuple[float, float, float] = (100.0, 100.0, 0.0)) -> DataFrame:
    """Every period for every item with links; the base period is the point itself, others may be null."""
    items = interval.select("item").distinct()
    base = calendar.agg(F.min("ord").alias("base"))
    grid = items.crossJoin(calendar.select("ord").distinct()).join(interval, ["item", "ord"], "left").crossJoin(F.broadcast(base))
    at = F.col("ord") == F.col("base")
    return grid.select("item", "ord", *(F.when(at, F.coalesce(c, F.lit(v))).otherwise(F.col(c)).alias(c) for c, v in zip(("low", "high", "error"), at_base, strict=True)))


def read_out(interval: DataFrame, publish: DataFrame, outlets_filtered: bool = False) -> DataFrame:
    """The interval at an item's last period as text, for items that the guard publishes; null if outlets are filtered."""
    from plumbline.functions.numbers import interval_text

    last = interval.groupBy("item").agg(F.max_by("low", "ord").alias("low"), F.max_by("high", "ord").alias("high"))
    applies = F.col("publish") & F.lit(not outlets_filtered)
    return last.join(publish.select("item", "publish"), "item", "left").select("item", F.when(applies, F.col("low")).alias("low"), F.when(applies, F.col("high")).alias("high"), F.when(applies, interval_text(F.col("low"), F.col("high"))).alias("text"))
