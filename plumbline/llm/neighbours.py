"""Approximate nearest neighbours: NN-descent builds a graph by Spark joins, greedy search answers queries.

Equal vectors are one node, so a group of copies never becomes a dense part of the graph; its rows
come back when results are expanded. Rounds refine ``(id, nb, sim)``: neighbours of a node, in both
directions, meet in one small group, where every pair that holds a new neighbour is compared.

The graph over all nodes compares vectors rounded to signed bytes, which can't tell apart the members
of a crowd (many unequal vectors nearer to each other than that rounding). Crowded nodes therefore get
a second graph over their vectors in double precision, and a query that meets one searches there too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, small_batches, written

#: Neighbours of a node; sampled neighbours of each kind in a round; pairs kept per neighbour and group.
DEGREE, SAMPLE, KEEP = 32, 20, 4
#: First graph: so many orders by random half-spaces, cut into runs that are compared within.
ORDERS, RUN = 4, 64
ENOUGH = 0.03
#: A node is crowded if all its DEGREE neighbours are at least this near; rounding shifts cosines by far less than 1 - CROWDED.
CROWDED = 0.99
#: Search: entry points drawn from all nodes, those a query starts at, candidates held per query.
ENTRIES, START, BEAM = 256, 40, 200

EDGE = "id long, nb long, sim double"
#: How the bytes of a node hold its vector: rounded for the graph over all nodes, in full for crowded ones.
ROUNDED, FULL = np.int8, np.float64


def matrix(units: list[bytes], kind: type) -> np.ndarray:
    """Vectors stored as ``kind``, each scaled to length 1; in double precision if stored in full."""
    x = np.frombuffer(b"".join(units), kind).reshape(len(units), -1).astype(np.float64 if kind is FULL else np.float32)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def packed(vectors: DataFrame, id_name: str, kind: type) -> DataFrame:
    """``(id, unit)``: each vector of ``(id, embedding)`` as bytes of ``kind``, its largest component 127 or 1."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False)).astype(np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                x = np.round(x * 127).astype(ROUNDED) if kind is ROUNDED else x
                yield pa.RecordBatch.from_arrays([batch.column(id_name), pa.array([r.tobytes() for r in x], pa.binary())], names=[id_name, "unit"])

    return vectors.select(id_name, "embedding").mapInArrow(run, f"{id_name} long, unit binary")


def groups(batches: Batches, key: str) -> Iterator[pa.RecordBatch]:
    """Batches of a stream sorted by ``key``, cut so that each holds whole groups."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        ids = batch.column(key).to_numpy()
        last = int(np.searchsorted(ids, ids[-1]))
        if last:
            yield batch.slice(0, last)
        held = batch.slice(last)
    if held is not None:
        yield held


def first_of(*columns: np.ndarray) -> np.ndarray:
    """Where rows sorted by ``columns`` begin a new tuple."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def edges_batch(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())], names=["id", "nb", "sim"])


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, unit)`` of the distinct usable vectors, and ``(vec_id, id, embedding)`` of their rows.

    Usable: not null, no null or non-finite component, not zero, and of the most frequent length.
    A node's id is its least vec_id; ``unit`` holds the vector as signed bytes, its
    largest component 127: the graph and the search compare these, results are scored anew.
    """
    small_batches(vectors.sparkSession)
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.coalesce(F.forall(numbers, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists(numbers, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long"), numbers.alias("embedding")).filter("vec_id is not null").filter(fine)
    size = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.filter(F.size("embedding") == (size["size"] if size else 0))
    digest = rows.withColumn("h", F.sha2(F.concat_ws(",", F.transform("embedding", lambda x: (x + 0.0).cast("string"))), 256))
    least = digest.groupBy("h").agg(F.min("vec_id").alias("id"))
    placed = written(digest.join(least, "h").select("vec_id", "id", "embedding"), "vectors")

    return written(packed(originals(placed), "id", ROUNDED), "nodes"), placed


def originals(rows: DataFrame) -> DataFrame:
    """``(id, embedding)`` of each node, of the rows ``(vec_id, id, embedding)``."""
    return rows.filter("vec_id = id").dropDuplicates(["id"]).select("id", "embedding")


def crowded(edges: DataFrame, rows: DataFrame) -> DataFrame:
    """``(id, unit)`` in full of the nodes whose neighbours all are nearer than rounding can order."""
    full = edges.groupBy("id").agg(F.count("*").alias("n"), F.min("sim").alias("least")).filter((F.col("n") >= DEGREE) & (F.col("least") >= CROWDED))
    return written(packed(originals(rows).join(full.select("id"), "id"), "id", FULL), "crowded")


def top(edges: DataFrame, n: int) -> DataFrame:
    """The ``n`` nearest of each id, each neighbour once; ``fresh`` stays false for those known before."""
    once = edges.repartition("id").groupBy("id", "nb").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh")).filter("sim is not null")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "nb"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= n).drop("rank")


def nearest_in(ids: np.ndarray, x: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Each row's ``n`` nearest within one run."""
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    n = min(n, len(ids) - 1)
    if n > 0:
        best = np.argpartition(-sims, n - 1, axis=1)[:, :n]
        yield edges_batch(np.repeat(ids, n), ids[best].ravel(), np.take_along_axis(sims, best, 1).ravel())


def first_graph(nodes: DataFrame, kind: type) -> DataFrame:
    """Edges between nodes that stand near each other in one of the orders: by half-spaces, or by plain projection for crowds, which no half-space cuts."""
    small_batches(nodes.sparkSession)

    def coded(batches: Batches) -> Batches:
        planes = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("unit").to_pylist(), kind)
            if planes is None:
                planes = np.random.default_rng(23).normal(size=(x.shape[1], ORDERS * 20)).astype(np.float32)
            shown = (x @ planes).reshape(len(x), ORDERS, 20)
            codes = shown[:, :, 0] if kind is FULL else ((shown > 0) * (1 << np.arange(19, -1, -1))).sum(2)
            turn = np.repeat(np.arange(ORDERS), len(x))
            yield pa.RecordBatch.from_arrays([pa.array(turn, pa.int64()), pa.array(codes.T.ravel(), pa.float64()), pa.array(np.tile(batch.column("id").to_numpy(), ORDERS), pa.int64()), pa.array(batch.column("unit").to_pylist() * ORDERS, pa.binary())], names=["turn", "code", "id", "unit"])

    def compared(batches: Batches) -> Batches:
        ids, units = [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            units += batch.column("unit").to_pylist()
            while len(ids) >= 2 * RUN:  # what is left stays with the last run
                yield from nearest_in(np.array(ids[:RUN]), matrix(units[:RUN], kind), DEGREE)
                ids, units = ids[RUN:], units[RUN:]
        if ids:
            yield from nearest_in(np.array(ids), matrix(units, kind), DEGREE)

    placed = nodes.mapInArrow(coded, "turn long, code double, id long, unit binary").repartitionByRange("turn", "code").sortWithinPartitions("turn", "code", "id")
    return top(placed.mapInArrow(compared, EDGE).filter("id <> nb").withColumn("fresh", F.lit(True)), DEGREE)


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.withColumns({"id": F.col("nb"), "nb": F.col("id")}))


def descend(edges: DataFrame, nodes: DataFrame, kind: type) -> DataFrame:
    """One round: neighbours of neighbours are compared, and each node keeps its nearest."""
    kinds = both_ways(edges.select("id", "nb", "fresh")).repartition("id").groupBy("id", "nb").agg(F.max("fresh").alias("fresh"))
    draw = F.row_number().over(Window.partitionBy("id", "fresh").orderBy(F.xxhash64("id", "nb"), "nb"))
    moving = F.max("fresh").over(Window.partitionBy("id"))  # a group without a fresh member has nothing to compare
    members = kinds.withColumns({"draw": draw, "moving": moving}).filter((F.col("draw") <= SAMPLE) & F.col("moving")).drop("draw", "moving")
    least = edges.groupBy("id").agg(F.when(F.count("*") >= DEGREE, F.min("sim")).otherwise(F.lit(-2.0)).alias("least"))
    known = nodes.join(least, "id", "left").select(F.col("id").alias("nb"), "unit", F.coalesce("least", F.lit(-2.0)).alias("least"))
    met = members.join(known, "nb").repartition("id").sortWithinPartitions("id")

    def compared(batches: Batches) -> Batches:
        held, n_held = [], 0
        for part in groups(batches, "id"):
            tried = part.filter(part.column("fresh"))  # without a nearness: says no more than that the pair has had its turn
            yield pa.RecordBatch.from_arrays([tried.column("id"), tried.column("nb"), pa.nulls(tried.num_rows, pa.float64())], names=["id", "nb", "sim"])
            held.append(_compare(part, kind))
            n_held += len(held[-1][0])
            if n_held > 2_000_000:
                yield from _nearest_of(held)
                held, n_held = [], 0
        yield from _nearest_of(held)

    found = met.mapInArrow(compared, EDGE).withColumn("fresh", F.col("sim").isNotNull())
    return top(edges.select("id", "nb", "sim", "fresh").unionByName(found), DEGREE)


def _nearest_of(found: list[tuple]) -> Iterator[pa.RecordBatch]:
    """What a task has found, each pair once and at most DEGREE a node: no other can be among its nearest."""
    if found:
        a, b, sim = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((b, -sim, a))
        a, b, sim = a[order], b[order], sim[order]
        once = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, bool)
        a, b, sim = a[once], b[once], sim[once]
        start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, int)
        kept = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a)))) < DEGREE
        for i in range(0, len(a), 100_000):
            k = kept[i : i + 100_000]
            yield edges_batch(a[i : i + 100_000][k], b[i : i + 100_000][k], sim[i : i + 100_000][k])


def _compare(part: pa.RecordBatch, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best pairs within each group of a batch that hold a fresh member and are nearer than the first's farthest."""
    key, nb = part.column("id").to_numpy(), part.column("nb").to_numpy()
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(start, len(key)))
    g, slot, most = np.repeat(np.arange(len(start)), size), np.arange(len(key)) - np.repeat(start, size), int(size.max())
    unit = matrix(part.column("unit").to_pylist(), kind)
    x = np.zeros((len(start), most, unit.shape[1]), unit.dtype)
    x[g, slot] = unit
    who = np.full((len(start), most), -1, np.int64)
    who[g, slot] = nb
    fresh = np.zeros((len(start), most), bool)
    fresh[g, slot] = part.column("fresh").to_numpy(zero_copy_only=False)
    floor = np.full((len(start), most), np.inf)
    floor[g, slot] = part.column("least").to_numpy()
    sims = x @ x.transpose(0, 2, 1)
    ok = (fresh[:, :, None] | fresh[:, None, :]) & (who[:, None, :] >= 0) & (sims > floor[:, :, None]) & (who[:, :, None] != who[:, None, :])
    sims = np.where(ok, sims, -np.inf)
    n = min(KEEP, most)
    best = np.argpartition(-sims, n - 1, axis=2)[:, :, :n]
    found = np.take_along_axis(sims, best, 2)
    a, b = np.broadcast_to(who[:, :, None], best.shape), np.take_along_axis(np.broadcast_to(who[:, None, :], sims.shape), best, 2)
    good = np.isfinite(found)
    return a[good], b[good], found[good]


def graph(nodes: DataFrame, kind: type = ROUNDED) -> DataFrame:
    """``(id, nb, sim, fresh)``, at most DEGREE neighbours a node; ends when few neighbours are new."""
    edges = written(first_graph(nodes, kind), "graph")
    while True:
        edges = written(descend(edges, nodes, kind), "graph")
        total, new = edges.agg(F.count("*"), F.count_if("fresh")).first()
        if new <= ENOUGH * total:
            return edges


def search(queries: DataFrame, edges: DataFrame, nodes: DataFrame, kind: type = ROUNDED, beam: int = BEAM) -> DataFrame:
    """``(query, nb, sim)``: up to ``beam`` nodes near each query ``(query, unit, home)``.

    Starts at ``home``, the query's own node or one near it, and at the nearest of a bounded number
    of entry points drawn by hash; then all unexpanded candidates of every query are expanded over the
    graph's links, both ways, until none is left among the nearest. A hop is one shuffle by query, in
    which what was reached meets what is held.
    """
    small_batches(nodes.sparkSession)
    links = written(both_ways(edges.select("id", "nb")).distinct().repartition("id"), "search-links")
    drawn = nodes.orderBy(F.xxhash64("id"), "id").limit(ENTRIES).toArrow()
    ids, points = np.array(drawn.column("id").to_pylist(), np.int64), drawn.column("unit").to_pylist()
    shared = nodes.sparkSession.sparkContext.broadcast((ids, points))
    schema = "query long, nb long, sim double, open boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def entered(batches: Batches) -> Batches:
        ids, points = shared.value
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            sims = matrix(batch.column("unit").to_pylist(), kind) @ matrix(points, kind).T
            n = min(START, len(ids))
            best = np.argpartition(-sims, n - 1, axis=1)[:, :n]
            rows = pa.array(np.repeat(batch.column("query").to_numpy(), n), pa.int64()), pa.array(ids[best].ravel(), pa.int64()), pa.array(np.take_along_axis(sims, best, 1).ravel(), pa.float64())
            yield pa.RecordBatch.from_arrays([*rows, pa.array(np.ones(best.size, bool))], names=names)

    def hopped(batches: Batches) -> Batches:
        """Of each query: candidates held (no unit) and reached (own and query's unit), each once, the nearest ``beam`` kept."""
        for part in groups(batches, "query"):
            query, nb = part.column("query").to_numpy(), part.column("nb").to_numpy()
            sim, open_ = part.column("sim").to_numpy(zero_copy_only=False).copy(), part.column("open").to_numpy(zero_copy_only=False).astype(bool)
            home = part.column("home").fill_null(-1).to_numpy()
            order = np.lexsort((home, np.isnan(sim), nb, query))  # what is held comes first and shuts out the same node reached
            pair = first_of(query[order], nb[order])
            held = ~np.isnan(sim[order[pair]])[np.cumsum(pair) - 1]
            order = order[pair | (~held & first_of(query[order], nb[order], home[order]))]
            new = order[np.isnan(sim[order])]
            for i in range(0, len(new), 10_000):
                some = pa.array(new[i : i + 10_000])
                mine, other = (matrix(part.column(c).take(some).to_pylist(), kind) for c in ("unit", "other"))
                sim[new[i : i + 10_000]] = (mine * other).sum(1)
            order = order[np.lexsort((-sim[order], nb[order], query[order]))]  # a query of several vectors: its nearest counts
            order = order[first_of(query[order], nb[order])]
            order = order[np.lexsort((nb[order], -sim[order], query[order]))]
            q = query[order]
            start = np.flatnonzero(first_of(q))
            order = order[np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q)))) < beam]
            yield pa.RecordBatch.from_arrays([pa.array(query[order]), pa.array(nb[order]), pa.array(sim[order]), pa.array(open_[order])], names=names)

    def best(held: DataFrame, reached: DataFrame) -> DataFrame:
        new = reached.select("query", "nb", F.lit(None).cast("double").alias("sim"), F.lit(True).alias("open"), "home", "unit", "other")
        both = held.unionByName(new, allowMissingColumns=True)
        return both.repartition("query").sortWithinPartitions("query").mapInArrow(hopped, schema)

    home = queries.filter("home is not null").select("query", F.col("home").alias("nb"), F.lit(1.0).alias("sim"), F.lit(True).alias("open"))
    held = written(queries.mapInArrow(entered, schema).unionByName(home).groupBy("query", "nb").agg(F.max("sim").alias("sim"), F.lit(True).alias("open")), "beam")
    known, asked = nodes.select(F.col("id").alias("nb"), F.col("unit").alias("other")), queries.select("query", "home", "unit")
    while True:
        reached = held.filter("open").select("query", F.col("nb").alias("id")).join(links, "id").select("query", "nb").join(known, "nb").join(asked, "query")
        held = written(best(held.withColumn("open", F.lit(False)), reached), "beam")
        if not held.filter("open").limit(1).count():
            break  # every hop closes all candidates held, and each node is opened once
    return held.select("query", "nb", "sim")


def nearest(vectors: DataFrame, wanted: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other rows found for each vec_id of ``wanted``.

    The score is the cosine of the original vectors in double precision; ties go to the smaller
    vec_id. Rows of one vec_id and vector count once. Vectors that can't be used take no part, as
    query or candidate; an empty table gives an empty table; extra columns are ignored.
    """
    nodes, rows = nodes_of(vectors)
    edges = graph(nodes)
    ask = written(rows.join(wanted.select("vec_id").distinct(), "vec_id").select(F.col("vec_id").alias("query"), F.col("id").alias("home"), "embedding").dropDuplicates(["query", "home"]), "queries")
    queries = ask.join(nodes, ask.home == nodes.id).select("query", "home", "unit")
    found = search(queries, edges, nodes)
    full = crowded(edges, rows)
    if full.limit(1).count():
        met = found.join(full.select(F.col("id").alias("nb")), "nb").groupBy("query").agg(F.max_by("nb", "sim").alias("near"))
        again = met.join(packed(ask.groupBy("query").agg(F.min_by("embedding", "home").alias("embedding")), "query", FULL), "query").select("query", F.col("near").alias("home"), "unit")
        found = found.unionByName(search(written(again, "queries"), graph(full, FULL), full, FULL)).groupBy("query", "nb").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("vec_id"))
    members = rows.select("vec_id", "id").distinct().withColumn("rank", rank).filter(F.col("rank") <= k + 1).select("vec_id", F.col("id").alias("nb"))
    def scaled(c: str):  # by a power of two, which rounds nothing: squares of huge and tiny components stay numbers
        most = F.array_max(F.transform(c, lambda x: F.abs(x)))
        by = F.pow(F.lit(2.0), F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), -F.floor(F.log2(most)).cast("double"))))
        return F.transform(c, lambda x: x * by)

    cosine = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    length = lambda c: F.sqrt(F.aggregate(F.col(c), F.lit(0.0), lambda s, x: s + x * x))
    whole = originals(rows).select(F.col("id").alias("nb"), scaled("embedding").alias("b"))
    scored = found.join(ask.select("query", scaled("embedding").alias("a")), "query").join(whole, "nb").select("query", "nb", (cosine / (length("a") * length("b"))).alias("score"))
    every = scored.join(members, "nb").filter("vec_id <> query")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", place).filter(F.col("rank") <= k).select(F.col("query").alias("query_id"), F.col("rank").cast("int"), "vec_id", "score")
