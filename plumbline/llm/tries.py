"""Prefix trie of conversations by van Emde Boas recursion, in as many rounds as its depth has bits.

A prefix is named by its depth and the smallest conversation that has it, so a conversation owns one run of its
path: from the depth where it is the smallest down to its end. The recursion finds where each run begins and on whose
run it stands. All sequences are cut at half depth; equal upper halves get one name, that of their smallest sequence, which
alone stays in the upper trie; lower halves go to the forest below the name. Both are cut again, all tries and forests of
a level in one round. Runs form a tree; totals are grafted from runs to the runs they stand on by pointer doubling, then
summed upward along each run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, looked_up, small_batches, written

#: Depths of one conversation that are kept together, as a power of two: no join or window has more rows a key.
CHUNK_BITS = 16
#: Bytes of ids that go on as one row to be hashed.
PIECE = 1 << 16

EMPTY = hashlib.sha256(b"").hexdigest()


def _chunk(depth: Column) -> Column:
    return F.shiftright(depth, CHUNK_BITS)


def _by_chunk(rows: DataFrame, depth: str, own: DataFrame, last: Column) -> DataFrame:
    """``rows`` (s, depth) with the columns of ``own`` (one row an s, ``last`` its last depth), dealt by s and chunk of depth."""
    spread = own.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(_chunk(last), F.lit(0)))))
    return rows.withColumn("_chunk", _chunk(F.col(depth))).join(spread, ["s", "_chunk"]).drop("_chunk")


def numbered(conversations: DataFrame) -> DataFrame:
    """``(s, depth, name, bytes)``: turns of conversation s numbered from 1, ``name`` standing for role and text.

    Turns are ordered by turn, null first; equal ones by a hash of role and text. Rows are dealt by ranges of that order, so
    a conversation may lie in many tasks: each counts its own rows, and at most one conversation a task goes on there
    from the task before.
    """

    def run(batches: Batches) -> Batches:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("s").to_numpy()
            if not len(ids):
                continue
            new = np.concatenate([[last is None or ids[0] != last], ids[1:] != ids[:-1]])
            start = np.where(new, np.arange(len(ids)), 0)
            place = np.arange(len(ids)) - np.maximum.accumulate(start) + 1
            head = np.argmax(new) if new.any() else len(ids)
            place[:head] = np.arange(1, head + 1) + seen
            last, seen = ids[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([batch.column("s"), pa.array(np.full(len(ids), part), pa.int64()), pa.array(place, pa.int64()), batch.column("name"), batch.column("bytes")], names=["s", "part", "place", "name", "bytes"])

    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("s"), "turn", name.alias("name"), F.octet_length(text).cast("long").alias("bytes"))
    order = ["s", F.col("turn").asc_nulls_first(), "name"]
    held = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "s long, part long, place long, name binary, bytes long"), "turns")
    counts = held.groupBy("s", "part").agg(F.max("place").alias("n"))
    before = F.sum("n").over(Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = counts.select("s", "part", before.alias("before")).filter("before is not null")  # one row a task at most
    return held.join(F.broadcast(carried), ["s", "part"], "left").select("s", (F.col("place") + F.coalesce("before", F.lit(0))).alias("depth"), "name", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(s, length)`` and ``(s, depth, name, bytes)`` of every conversation with its first turns exchanged.

    The first ``h`` turns of s, ``h`` the crc32 of its decimal modulo 9, give way to the first ``h`` turns of s - s % 5, as
    far as that has any. The remainder has the sign of s.
    """
    h = F.crc32(F.col("s").cast("string")) % 9
    convs = turns.groupBy("s").agg(F.max("depth").alias("n")).withColumn("base", F.col("s") - F.col("s") % 5).withColumn("h", h)
    bases = convs.filter("s = base").select("base", F.col("n").alias("of_base"))
    shaped = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("of_base", F.lit(0))))
    shaped = written(shaped.select("s", "n", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "shapes")
    tails = _by_chunk(turns.filter(F.col("depth") > h), "depth", shaped.select("s", "n", "h", "head"), F.col("n"))
    own = tails.select("s", (F.col("depth") - F.col("h") + F.col("head")).alias("depth"), "name", "bytes")
    heads = turns.filter("depth <= 8 and s % 5 = 0").withColumnRenamed("s", "base")
    taken = shaped.select("s", "base", "head").join(heads, "base").filter(F.col("depth") <= F.col("head")).select("s", "depth", "name", "bytes")
    return shaped.select("s", "length"), taken.unionByName(own)


def marks(depth: Column, name: Column) -> list[Column]:
    """Two 64-bit marks of a turn at its depth; the exclusive or over a stretch names the stretch."""
    return [F.xxhash64(F.lit(i), depth, name).alias(f"x{i}") for i in (1, 2)]


def halves(turns: DataFrame, rounds: int) -> DataFrame:
    """``(level, s, block, x1, x2)``: names of all upper halves; blocks of ``2 ** level`` turns of even number."""
    at = F.explode(F.transform(F.sequence(F.lit(0), F.lit(rounds - 1)), lambda i: F.struct(i.alias("level"), F.floor((F.col("depth") - 1) / F.pow(F.lit(2), i)).alias("block"))))
    rows = turns.select("s", "depth", *marks(F.col("depth"), F.col("name")), at.alias("at")).select("s", "x1", "x2", "at.*").filter("block % 2 = 0")
    return rows.groupBy("level", "s", "block").agg(*(F.bit_xor(x).alias(x) for x in ("x1", "x2")))


def runs(seqs: DataFrame, turns: DataFrame, root: int, longest: int) -> DataFrame:
    """``(s, parent, start)``: the depth where each sequence's own run begins and the run on which it stands.

    ``seqs`` (s, length) are distinct sequences, ``turns`` theirs. A sequence that ends on another's run starts one
    below its end. One round a level; the state has the sequences without a run yet, each in one place, and the owners
    of the forests they are in.
    """
    rounds = max(0, (longest - 1).bit_length())
    named = written(halves(turns, rounds), "halves", "level") if rounds else None
    now = seqs.filter("length > 0").select(F.lit(0).cast("long").alias("block"), "s", F.lit(root).cast("long").alias("forest"), "length")
    found = seqs.filter(F.col("s") != root).filter("length = 0").select("s", F.lit(root).cast("long").alias("parent"), F.lit(1).cast("long").alias("start"))
    for level in reversed(range(rounds)):
        upper = now.withColumn("half", F.col("block") * 2).join(named.filter(F.col("level") == level).select("s", F.col("block").alias("half"), "x1", "x2"), ["s", "half"])
        cut = (F.col("half") + 1) * (1 << level)
        upper = upper.withColumn("goes_on", (F.col("length") > cut).cast("long"))
        key = ["half", "forest", "x1", "x2"]
        classes = upper.groupBy(*key).agg(F.min("s").alias("owner"), F.sum("goes_on").alias("below"))
        cuts = written(looked_up(upper, classes, key, "s", "inner").select("half", "s", "forest", "length", "owner", "below", "goes_on"), "cuts")
        left = F.col("s") != F.col("owner")
        settled = cuts.filter(left & (F.col("below") * F.col("goes_on") < 2))  # ends at the cut, or alone below it
        found = found.unionByName(settled.select("s", F.col("owner").alias("parent"), (cut + 1).alias("start")))
        stays = cuts.filter(~left).select(F.col("half").alias("block"), "s", "forest", "length")
        lower = cuts.filter("goes_on = 1 and below > 1").select((F.col("half") + 1).alias("block"), "s", F.col("owner").alias("forest"), "length")
        now = stays.unionByName(lower)
    last = now.filter("s <> forest").select("s", F.col("forest").alias("parent"), (F.col("block") + 1).alias("start"))
    return found.unionByName(last)


class Grafts:
    """Sums over the tree of runs: tables of each run's ancestor at distance 1, 2, 4, ... serve any number of sums."""

    def __init__(self, tree: DataFrame, root: int):
        """``tree`` (s, parent) without the root."""
        self.jumps, now = [], written(tree.select("s", F.col("parent").alias("to")), "jumps")
        while now.limit(1).count():
            self.jumps.append(now)
            far = now.filter(F.col("to") != root)  # nothing stands below the root
            step = now.select(F.col("s").alias("to"), F.col("to").alias("next"))
            now = written(looked_up(far, step, ["to"], "s", "inner").select("s", F.col("next").alias("to")), "jumps")

    def total(self, values: DataFrame, names: list[str]) -> DataFrame:
        """``values`` (s, names) summed over each run and all that stand on it."""
        for jump in self.jumps:
            more = jump.join(values, "s").groupBy(F.col("to").alias("s")).agg(*(F.sum(n).alias(f"_{n}") for n in names))
            values = written(values.join(more, "s", "left").select("s", *((F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names)), "grafts")
        return values


def upward(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` (s, depth) with ``names`` summed from each depth down to the run's end; chunk by chunk, then within."""
    rows = rows.withColumn("_chunk", _chunk(F.col("depth")))
    sums = rows.groupBy("s", "_chunk").agg(*(F.sum(n).alias(n) for n in names))
    below = Window.partitionBy("s").orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("s", "_chunk", *(F.sum(n).over(below).alias(f"_{n}") for n in names)).filter(F.col(f"_{names[0]}").isNotNull())
    inside = Window.partitionBy("s", "_chunk").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(carried, ["s", "_chunk"], "left")
    return joined.withColumns({n: F.sum(n).over(inside) + F.coalesce(f"_{n}", F.lit(0)) for n in names}).drop("_chunk", *(f"_{n}" for n in names))


def id_hashes(members: DataFrame) -> DataFrame:
    """``(s, ends_sha256)``: SHA-256 of the ascending decimal ids of each class, joined by commas.

    ``members`` (s, conv_id). Ranges of the order are joined to pieces first, so the one task that must hash a class in order
    reads few rows and holds one piece.
    """

    def pieces(batches: Batches) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for s, conv in zip(batch.column("s").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if s != key or size >= PIECE:
                    if held:
                        out.append((key, first, ",".join(held)))
                    key, first, held, size = s, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield _rows(out)
                out = []
        if held:
            yield _rows([(key, first, ",".join(held))])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string())], names=["s", "first", "piece"])

    def hashed(batches: Batches) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for s, piece in zip(batch.column("s").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                if s != key:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = s, hashlib.sha256()
                    state.update(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], names=["s", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([state.hexdigest()], pa.string())], names=["s", "ends_sha256"])

    ordered = members.select("s", "conv_id").repartitionByRange("s", "conv_id").sortWithinPartitions("s", "conv_id")
    cut = ordered.mapInArrow(pieces, "s long, first long, piece string")
    return cut.repartition("s").sortWithinPartitions("s", "first").mapInArrow(hashed, "s long, ends_sha256 string")


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every trie node.

    ``conversations`` (conv_id, turn, role, text); other columns are ignored. Conversations are rebuilt first (see ``rebuilt``).
    Rows with a null conv_id belong to none. Null role or text is empty; a null turn comes first, and equal turns stand in the
    order of a hash of role and text, so repeated rows are turns of their own. A table without a conversation has no node,
    one whose rebuilt conversations have no turn has the root only.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    lengths, turns = rebuilt(written(numbered(conversations), "numbered"))
    turns = written(turns, "rebuilt")
    whole = turns.groupBy("s").agg(*(F.bit_xor(m).alias(f"x{i}") for i, m in enumerate(marks(F.col("depth"), F.col("name")), 1)))
    whole = lengths.join(whole, "s", "left").fillna(0, ["x1", "x2"]).withColumnRenamed("s", "conv_id")
    key = ["length", "x1", "x2"]
    classes = whole.groupBy(*key).agg(F.min("conv_id").alias("s"), F.count("*").alias("weight"))
    members = written(looked_up(whole, classes, key, "conv_id", "inner").select("conv_id", "s", "length", "weight"), "members")
    seqs = members.filter("conv_id = s").select("s", "length", "weight")
    root, longest = seqs.agg(F.min("s"), F.max("length")).first()
    if root is None:
        return spark.createDataFrame([], NODES)
    turns = written(_by_chunk(turns, "depth", seqs.select("s", "length"), F.col("length")).drop("length"), "distinct")

    tree = runs(seqs.select("s", "length"), turns, root, longest)
    top = spark.createDataFrame([(root, None, 0)], "s long, parent long, start long")
    paths = written(tree.unionByName(top).join(seqs, "s"), "runs")
    below = paths.filter("parent is not null").withColumn("at", F.col("start") - 1)
    grafts = Grafts(below, root)

    heavy = grafts.total(paths.select("s", "weight"), ["weight"])
    hung = below.drop("weight").join(heavy, "s").groupBy(F.col("parent").alias("s"), F.col("at").alias("depth")).agg(F.sum("weight").alias("hung"), F.count_if(F.col("start") <= F.col("length")).alias("branches"))
    rows = _by_chunk(turns.select("s", "depth", "bytes"), "depth", paths, F.col("length")).filter(F.col("depth") >= F.col("start"))
    first = paths.filter(F.col("s") == root).select("s", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), "parent", "start", "length", "weight")
    own = rows.select(first.columns).unionByName(first).join(hung, ["s", "depth"], "left").fillna(0, ["hung", "branches"])
    counted = upward(own, ["hung"]).withColumn("n_convs", F.col("weight") + F.col("hung")).withColumn("n_children", F.col("branches") + (F.col("depth") < F.col("length")).cast("long"))
    nodes = written(counted.select(
        "s", "depth", F.when(F.col("depth") == F.col("start"), F.col("parent")).otherwise(F.col("s")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    ), "nodes")

    totals = ["n_leaves", "saved_tokens"]
    each = paths.select("s").join(nodes.groupBy("s").agg(*(F.sum(n).alias(n) for n in totals)), "s", "left").fillna(0, totals)
    grafted = below.join(grafts.total(each, totals), "s").groupBy(F.col("parent").alias("s"), F.col("at").alias("depth")).agg(*(F.sum(n).alias(f"hung_{n}") for n in totals))
    full = nodes.join(grafted, ["s", "depth"], "left").select("s", "depth", "parent_conv_id", "n_convs", "n_children", *((F.col(n) + F.coalesce(f"hung_{n}", F.lit(0))).alias(n) for n in totals))
    end = F.when(F.col("start") <= F.col("length"), F.col("s")).otherwise(F.coalesce("parent", "s"))
    ends = id_hashes(members).join(paths, "s").select(end.alias("s"), F.col("length").alias("depth"), "ends_sha256")
    done = upward(full, totals).join(ends, ["s", "depth"], "left")
    return done.select(F.col("s").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", *totals, F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
