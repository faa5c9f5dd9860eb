"""Hard negatives by segment summaries: bounds from segments' means and deviations, then exact scores.

A segment of ``m`` components with mean ``a`` and deviation ``s`` (root of the mean square distance from ``a``)
has an inner product with another's segment within ``m * (a * a' - s * s')`` and ``m * (a * a' + s * s')``, as
the residuals obey Cauchy and Schwarz. Summed over the segments of two vectors that bounds their score; halving
segments tightens it. Vectors are stored in packed blocks with the summaries of every level. A block of them meets a
block of anchors in one task: level by level, rows and anchors that no bound lets through leave the pair of blocks, and
scores are computed for what is left. The bounds only save work: results are those of comparing all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, small_batches, written

#: Segments of a vector at each level.
LEVELS = (1, 4, 16)
#: Vectors in a block, of the table and of anchors: a matrix of scores has 8 MB.
BLOCK, ANCHORS = 2048, 512

PACKED = "ids binary, labels binary, parts binary, means binary, deviations binary, width int"
NONE = -np.iinfo(np.int64).max


def usable(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """``(vec_id, label, parts)``: labels as asked, components ``floor(scale * x)``; rows with anything null or not finite are left out."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))  # not a number is above all
    rows = vectors.filter("vec_id is not null and label is not null and embedding is not null").filter(sound)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("parts"))


def summaries(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of all levels, side by side."""
    means, deviations = [], []
    for segments in LEVELS:
        cut = parts.reshape(len(parts), segments, -1).astype(np.float64)
        means.append(cut.mean(2))
        deviations.append(cut.std(2))
    return np.hstack(means), np.hstack(deviations)


def blocks(rows: DataFrame, width: int, size: int) -> DataFrame:
    """Vectors (vec_id, label, parts) in packed blocks of up to ``size``; shorter vectors end in zeros."""

    def packed(ids: list[int], labels: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        filled = np.zeros((len(ids), width), np.int64)
        for i, p in enumerate(parts):
            filled[i, : len(p)] = p
        means, deviations = summaries(filled)
        kind = np.int16 if -(1 << 15) <= filled.min(initial=0) and filled.max(initial=0) < 1 << 15 else np.int64
        columns = [np.array(ids, "<i8"), np.array(labels, "<i8"), filled.astype(kind), means, deviations]
        return pa.RecordBatch.from_arrays([*(pa.array([c.tobytes()], pa.binary()) for c in columns), pa.array([np.dtype(kind).itemsize], pa.int32())], names=["ids", "labels", "parts", "means", "deviations", "width"])

    def run(batches: Batches) -> Batches:
        ids, labels, parts = [], [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            labels += batch.column("label").to_pylist()
            flat, at = batch.column("parts").values.to_numpy(zero_copy_only=False), batch.column("parts").offsets.to_numpy()
            parts += [flat[a:b] for a, b in zip(at, at[1:], strict=False)]
            while len(ids) >= size:
                yield packed(ids[:size], labels[:size], parts[:size])
                ids, labels, parts = ids[size:], labels[size:], parts[size:]
        if ids:
            yield packed(ids, labels, parts)

    return rows.mapInArrow(run, PACKED)


class Block:
    """A packed block as arrays; ``levels``: first column and number of the segments of each level."""

    def __init__(self, row: dict, width: int):
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.parts = np.frombuffer(row["parts"], np.int16 if row["width"] == 2 else np.int64).reshape(-1, width)
        self.means, self.deviations = (np.frombuffer(row[c]).reshape(len(self.ids), -1) for c in ("means", "deviations"))
        self.largest = max(int(self.parts.max(initial=0)), -int(self.parts.min(initial=0)))

    def kept(self, of: np.ndarray) -> Block:
        other = object.__new__(Block)
        for name in ("ids", "labels", "parts", "means", "deviations"):
            setattr(other, name, getattr(self, name)[of])
        other.largest = self.largest
        return other


def bounds(a: Block, b: Block, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of every pair, from the segments of a level."""
    first, n = sum(LEVELS[:level]), LEVELS[level]
    here, m = slice(first, first + n), a.parts.shape[1] // n
    middle, spread = m * (a.means[:, here] @ b.means[:, here].T), m * (a.deviations[:, here] @ b.deviations[:, here].T)
    slack = 0.5 + 1e-9 * (np.abs(middle) + spread)  # of rounding: scores are whole
    return middle - spread - slack, middle + spread + slack


def scores(a: Block, b: Block) -> np.ndarray:
    """Exact inner products; raises if one might not fit a long."""
    most = a.largest * b.largest * a.parts.shape[1]
    if most < 1 << 53:
        return (a.parts.astype(np.float64) @ b.parts.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a.parts.astype(np.int64) @ b.parts.astype(np.int64).T
    raise ValueError("inner products of these components don't fit a long")


def surviving(a: Block, b: Block, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors and rows that are left after all levels, and a mask of their pairs.

    ``wanted(anchors, rows, low, high)`` says which pairs the bounds let through; it gets the places left.
    """
    i, j = np.arange(len(a.ids)), np.arange(len(b.ids))
    mask = np.ones((len(i), len(j)), bool)
    for level in range(len(LEVELS)):
        mask = mask & wanted(i, j, *bounds(a.kept(i), b.kept(j), level))
        rows, columns = mask.any(1), mask.any(0)
        i, j, mask = i[rows], j[columns], mask[np.ix_(rows, columns)]
        if not len(i):
            break
    return i, j, mask


class Best:
    """The first ``k`` rows by (score descending, vec_id) for each of ``n`` lists; filled from blocks."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), NONE, np.int64), np.zeros((n, k), np.int64)

    def least(self) -> np.ndarray:
        """The score a row must reach to enter each list."""
        return self.score[:, -1]

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> None:
        """Rows ``ids`` with ``score`` (lists x rows) for the lists ``of``, where the mask is set."""
        k = self.score.shape[1]
        open_to = np.where(mask & (score >= self.least()[of][:, None]), score, NONE)
        if open_to.shape[1] > k:
            open_to[open_to < np.partition(open_to, -k, axis=1)[:, -k][:, None]] = NONE
        a, b = np.nonzero(open_to != NONE)
        for x in np.unique(a):
            own = b[a == x]
            s, d = np.concatenate([self.score[of[x]], open_to[x, own]]), np.concatenate([self.id[of[x]], ids[own]])
            first = np.lexsort((d, -s))[:k]
            self.score[of[x]], self.id[of[x]] = s[first], d[first]


def _paired(table: DataFrame, anchors: DataFrame, asked: list[str]) -> DataFrame:
    """Every block of the table with every block of anchors: a stated query set against all rows, in blocks.

    Spark sends the anchors' blocks to all if their files are below its own bound of size, and else
    deals out pairs of partitions.
    """
    left = table.select(*(F.col(c).alias(f"b_{c}") for c in table.columns))
    return left.crossJoin(anchors.select("block", *(F.col(c).alias(f"a_{c}") for c in asked)))


def _side(row: dict, prefix: str, width: int) -> Block:
    return Block({k: row[f"{prefix}_{k}"] for k in ("ids", "labels", "parts", "means", "deviations", "width")}, width)


def _positives(table: DataFrame, anchors: DataFrame, width: int, k: int) -> DataFrame:
    """``(anchor_id, vec_id, score)``: the first ``k`` rows of the anchor's label in each task."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, Best]] = {}
        for row in (r for batch in batches for r in batch.to_pylist()):
            a, b = _side(row, "a", width), _side(row, "b", width)
            _, best = held.setdefault(row["block"], (a.ids, Best(len(a.ids), k)))
            alike = (a.labels[:, None] == b.labels) & (a.ids[:, None] != b.ids)
            i, j, mask = surviving(a, b, lambda i, j, low, high: alike[np.ix_(i, j)] & (high >= best.least()[i][:, None]))  # noqa: B023
            if len(i):
                best.add(i, scores(a.kept(i), b.kept(j)), b.ids[j], mask)
        for ids, best in held.values():
            a, c = np.nonzero(best.score != NONE)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids[a], best.id[a, c], best.score[a, c])], names=["anchor_id", "vec_id", "score"])

    return _paired(table, anchors, [*PACKED_NAMES]).mapInArrow(run, "anchor_id long, vec_id long, score long")


def _negatives(table: DataFrame, anchors: DataFrame, width: int, k: int, low: int, high: int) -> DataFrame:
    """``(anchor_id, place, vec_id, score)``: per positive number ``place`` the first ``k`` rows of other labels in its band in each task.

    The anchors' blocks bring ``lists``: a row of positive scores for each anchor, ``NONE`` where there is none.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, list[Best]]] = {}
        for row in (r for batch in batches for r in batch.to_pylist()):
            a, b = _side(row, "a", width), _side(row, "b", width)
            positive = np.frombuffer(row["a_lists"], "<i8").reshape(len(a.ids), -1)
            some = positive != NONE
            safe = np.where(some, positive, 0)
            first, last = np.where(some, -(-low * safe // 100), 1), np.where(some, high * safe // 100, 0)  # none: an empty band
            _, best = held.setdefault(row["block"], (a.ids, [Best(len(a.ids), k) for _ in range(positive.shape[1])]))
            entry = np.stack([np.maximum(first[:, p], x.least()) for p, x in enumerate(best)], 1)
            other = a.labels[:, None] != b.labels

            def wanted(i, j, least, most):
                hit = np.zeros(least.shape, bool)
                for p in range(positive.shape[1]):  # noqa: B023
                    hit |= (most >= entry[i, p, None]) & (least <= last[i, p, None]) & (first[i, p, None] <= last[i, p, None])  # noqa: B023
                return hit & other[np.ix_(i, j)]  # noqa: B023

            i, j, mask = surviving(a, b, wanted)
            if len(i):
                exact = scores(a.kept(i), b.kept(j))
                for p, x in enumerate(best):
                    x.add(i, exact, b.ids[j], mask & (exact >= first[i, p, None]) & (exact <= last[i, p, None]))
        for ids, best in held.values():
            for p, x in enumerate(best):
                a, c = np.nonzero(x.score != NONE)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a], pa.int64()), pa.array(np.full(len(a), p), pa.int32()), pa.array(x.id[a, c], pa.int64()), pa.array(x.score[a, c], pa.int64())], names=["anchor_id", "place", "vec_id", "score"])

    return _paired(table, anchors, [*PACKED_NAMES, "lists"]).mapInArrow(run, "anchor_id long, place int, vec_id long, score long")


PACKED_NAMES = [x.split()[0] for x in PACKED.split(", ")]


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each list with their rank; what tasks have cut to ``k`` is cut again before it is shuffled."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _listed(blocks: DataFrame, positives: DataFrame, k: int) -> DataFrame:
    """Anchors' blocks with ``lists``, the scores of their positives, numbered by rank."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                lists, place = np.full((len(ids), k), NONE, "<i8"), {x: i for i, x in enumerate(ids.tolist())}
                for found in row["found"] or []:
                    lists[place[found["anchor_id"]], found["rank"] - 1] = found["score"]
                out.append({k: v for k, v in row.items() if k != "found"} | {"lists": lists.tobytes()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int64()), *((c, pa.int32() if c == "width" else pa.binary()) for c in PACKED_NAMES), ("lists", pa.binary())]))

    own = blocks.mapInArrow(_members, "block long, anchor_id long")
    found = own.join(positives, "anchor_id").groupBy("block").agg(F.collect_list(F.struct("anchor_id", "rank", "score")).alias("found"))  # k an anchor at most, a block of anchors
    return blocks.join(found, "block", "left").select("block", *PACKED_NAMES, "found").mapInArrow(run, f"block long, {PACKED}, lists binary")


def _members(batches: Batches) -> Batches:
    for batch in batches:
        for block, ids in zip(batch.column("block").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            found = np.frombuffer(ids, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block), pa.int64()), pa.array(found, pa.int64())], names=["block", "anchor_id"])


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from (vec_id, label, embedding).

    Anchors are rows whose vec_id is divisible by ``every``. A row with a null vec_id, label, vector or component, or
    with a component that isn't finite, takes no part; extra columns are ignored. Vectors of fewer components than the longest
    count zeros for the rest. Ties go to the smaller vec_id. Rows that repeat a vec_id are rows of their own, but
    an anchor's own id is never its positive, and repeated anchors count once, by the least (label, components). A band
    without a row, a label of one row and an empty table give no rows. A score that might not fit a long raises.

    The vectors are written once in packed blocks and read in place by two passes; a task hands on
    ``positives`` rows, then ``positives * negatives``, for each anchor it has met.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = usable(vectors)
    longest = rows.agg(F.max(F.size("parts"))).first()[0] or 0
    width = max(1, -(-longest // LEVELS[-1])) * LEVELS[-1]
    table = written(blocks(rows, width, BLOCK), "vectors")
    chosen = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "parts")).alias("x")).select("vec_id", "x.*")
    anchors = written(blocks(chosen, width, ANCHORS).select(F.monotonically_increasing_id().alias("block"), *PACKED_NAMES), "anchors")
    near = written(_ranked(_positives(table, anchors, width, positives), ["anchor_id"], positives), "positives")
    listed = written(_listed(anchors, near, positives), "bands")
    far = _ranked(_negatives(table, listed, width, negatives, low, high), ["anchor_id", "place"], negatives)
    known = near.select("anchor_id", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(known, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
