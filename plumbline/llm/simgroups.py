"""Groups of near copies: SimHash links first, an exact rest by shared rare shingles, shingle sets decide.

Used where copies are to be dropped: links are pairs whose sets of five-word shingles have a Jaccard
similarity of at least 0.8. Most of them have fingerprints within a few bits, so the vantage-point
trees of ``simhash`` give spanning links first, one row a member, and those that the shingle sets
confirm join groups. Fingerprints promise nothing, so an exact rest follows for texts of different
groups: two sets that similar share one of the first ``n - ceil(0.8 n) + 1`` shingles in any order
common to all texts, so texts that share one of these are compared, and no such pair is passed over.
The order puts rare shingles first, by counts of a bounded sample; it decides the work only, never the
result. Of the pairs proposed, those go at once whose sizes or parity bits (a lower bound of the number of
shingles that only one of them has) already exclude the similarity; whole shingle sets decide on the rest.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, bit_map, discard, frugal, marked, small_batches, texts_of, written
from plumbline.llm.components import components
from plumbline.llm.simhash import links, majority, shingle_hashes

#: Texts whose shingles are counted for the order, and places of the counts; less than LEAST counts as rare.
SAMPLE, PLACES, LEAST = 8_000, 1 << 21, 3
#: Parity bits of a text: a power of two, at least twice its shingles, and at most these 64-bit words.
MOST_WORDS = 1 << 10
#: Texts of one block: those that share a shingle are compared by pairs of blocks, each in a task of its own.
BLOCK = 1_000
#: Fingerprints within DISTANCE bits are linked first, over trees of BLOCKS blocks.
DISTANCE, BLOCKS = 7, 4
#: Pairs proposed per document and pair of blocks in the first round; each later round proposes the next ones, up to
#: sixteen times as many, of those that still lie in different groups, until none is left.
FIRST = 8


def _common(texts: DataFrame, shingle_words: int) -> np.ndarray:
    """How often the shingles of each place occur in about SAMPLE texts."""

    def run(batches: Batches) -> Batches:
        counts = np.zeros(PLACES, np.int64)
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, shingle_words)) for t in texts_of(batch)]
            counts += np.bincount((np.concatenate([np.empty(0, np.uint64), *sets]) % np.uint64(PLACES)).astype(np.int64), minlength=PLACES)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["place", "n"])

    n = texts.count()
    drawn = texts.select("text") if n <= SAMPLE else texts.filter(F.pmod(F.xxhash64("doc_id", "key"), F.lit(1_000_003)) < math.ceil(1_000_003 * SAMPLE / n)).select("text")
    got = drawn.mapInArrow(frugal(run), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST).toArrow()
    out = np.zeros(PLACES, np.uint16)
    out[got.column("place").to_numpy()] = np.minimum(got.column("n").to_numpy(), 65_535)
    return out


def first_shingles(shingles: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of which two sets of the given similarity share one; 0 for an empty set."""
    if not len(shingles):
        return np.zeros(1, np.uint64)
    order = np.lexsort((shingles, common[shingles % np.uint64(PLACES)]))
    return shingles[order[: len(shingles) - math.ceil(similarity * len(shingles) - 1e-9) + 1]]


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls to each place, as 64-bit words; halves laid over each other give those of half as many places."""
    words = min(MOST_WORDS, 1 << max(0, (2 * len(shingles) - 1).bit_length() - 6))
    places = ((shingles >> np.uint64(20)) % np.uint64(64 * words)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=64 * words) & 1).astype(np.uint8)).view(np.int64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Parities as those of fewer places."""
    return np.bitwise_xor.reduce(bits.reshape(*bits.shape[:-1], -1, words), -2) if bits.shape[-1] > words else bits


def may_be_similar(n: int, bits: np.ndarray, m: int, other: np.ndarray, similarity: float) -> bool:
    """False if sizes or parities exclude the similarity: places that differ are at most the shingles of one set only."""
    words = min(len(bits), len(other))
    apart = np.bitwise_count((folded(bits, words) ^ folded(other, words)).view(np.uint64)).sum(dtype=np.int64)
    return min(n, m) >= similarity * max(n, m) and apart <= (1 - similarity) / (1 + similarity) * (n + m) + 1e-6


def _packed(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(id, packed)``: the compressed texts of ``wanted`` (id, rep, key).

    Texts are passed over where they stand, by a bit map of those wanted; only those that pass are joined.
    Compressed texts are a quarter of their shingle hashes.
    """
    bits = texts.sparkSession.sparkContext.broadcast(bit_map(wanted.select(F.xxhash64("rep", "key").alias("h"))))

    def run(batches: Batches) -> Batches:
        pack = zstandard.ZstdCompressor().compress
        for batch in batches:
            batch = batch.filter(pa.array(marked(bits.value, batch.column("h").to_numpy())))
            packed = [pack(t.encode("utf-8")) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(packed, pa.binary())], names=["doc_id", "key", "packed"])

    found = texts.select("doc_id", "key", F.xxhash64("doc_id", "key").alias("h"), "text").mapInArrow(frugal(run), "doc_id long, key string, packed binary")
    named = wanted.select("id", "rep", F.col("key").alias("k"))
    return found.join(named, F.col("key") == F.col("k")).filter(F.col("doc_id").eqNullSafe(F.col("rep"))).dropDuplicates(["k"]).select("id", "packed")


def _marks(docs: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """``(doc_id, key, n, fp, bits, firsts)``: digest of the text, number of distinct shingles, fingerprint, parities, first shingles."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, shingle_words))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            every = [shingle_hashes(t, shingle_words) for t in texts_of(batch)]
            fps = np.array(list(map(majority, every)), np.uint64).view(np.int64)
            sets = list(map(np.unique, every))
            firsts = [first_shingles(x, common.value, similarity).view(np.int64).tobytes() for x in sets]
            columns = [pa.array(list(map(len, sets)), pa.int64()), pa.array(fps), pa.array(list(map(parities, sets)), pa.list_(pa.int64())), pa.array(firsts, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *columns], names=["doc_id", "key", "n", "fp", "bits", "firsts"])

    return docs.select("doc_id", "key", "text").mapInArrow(frugal(run), "doc_id long, key string, n long, fp long, bits array<long>, firsts binary")


def index_length(n: int | np.ndarray, similarity: float):
    """Of the first shingles of a set, those among which the first one shared with a set not smaller lies.

    Two such sets share ``2 s / (1 + s)`` of the smaller one's shingles at least, none of them before that one.
    """
    return n - np.ceil(2 * similarity / (1 + similarity) * n - 1e-9).astype(np.int64) + 1


def _shared(classes: DataFrame, similarity: float) -> DataFrame:
    """``(unit, block, id)``: the texts that share a first shingle, by pairs of blocks.

    A text stays with a shingle only if another one of fitting size is there and the shingle stands early
    enough in the smaller one. Shingles shared by the same texts are one. A unit holds one block, or two
    of which only pairs across are wanted.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            firsts = [np.frombuffer(x, np.int64) for x in batch.column("firsts").to_pylist()]
            sizes = np.array(list(map(len, firsts)), np.int64)
            ids, n = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("id", "n"))
            place = np.concatenate([np.empty(0, np.int64), *map(np.arange, sizes)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *firsts])), pa.array(ids), pa.array(n), pa.array(place < index_length(n, similarity))], names=["first", "id", "n", "early"])

    over = Window.partitionBy("first")
    line = over.orderBy("n", "id")
    rows = classes.select("id", "n", "firsts").mapInArrow(frugal(run), "first long, id long, n long, early boolean")
    larger, smaller = F.lead("n").over(line), F.last(F.when(F.col("early"), F.col("n")), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    ratio = F.lit(similarity - 1e-9)
    met = rows.withColumns({"larger": larger, "smaller": smaller}).filter((F.col("early") & (F.col("n") >= ratio * F.col("larger"))) | (F.col("smaller") >= ratio * F.col("n")))
    found = met.select("id", F.bit_xor(F.xxhash64("id")).over(over).alias("those"), F.count("*").over(over).alias("size")).filter("size > 1").distinct()
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = found.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.select(F.struct("those", "size", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).alias("unit"), "block", "id")


def _proposed(n: np.ndarray, block: np.ndarray, group: np.ndarray, bits: list[np.ndarray], similarity: float, across: bool, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of positions, in order of size, that may be similar and lie in different groups.

    Each position gives its partners number ``lo`` to ``hi`` - 1 among the later ones; True if there are more.
    """
    left, right, more = [], [], False
    ends = np.searchsorted(n, np.floor(n / similarity + 1e-9), "right")
    words, own, first = np.array(list(map(len, bits))), None, 0
    for i in range(len(n) - 1):
        if own is None or own.shape[1] != words[i]:  # sizes ascend, and so do the words
            first, last = i, int(ends[np.searchsorted(words, words[i], "right") - 1])
            own = np.stack([folded(x, int(words[i])) for x in bits[first:last]])
        diff = np.bitwise_count((own[i + 1 - first : ends[i] - first] ^ own[i - first]).view(np.uint64)).sum(1, dtype=np.int64)
        near = np.flatnonzero(diff <= (1 - similarity) / (1 + similarity) * (n[i + 1 : ends[i]] + n[i]) + 1e-6)
        if across:
            near = near[block[near + i + 1] != block[i]]
        if len(near):
            apart = group[near + i + 1] != group[i]
            more |= bool(apart[hi:].any())
            near = near[lo:hi][apart[lo:hi]]
            left.append(np.full(len(near), i))
            right.append(near + i + 1)
    none = np.empty(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none]), more


def _confirmed(pairs: DataFrame, texts: DataFrame, known: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` of ids whose whole shingle sets are similar; written."""
    needed = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(known.select("id", "rep", "key"), "id"), "needed")
    packed = written(_packed(texts, needed), "packed")
    both = pairs.join(packed.select(F.col("id").alias("a"), F.col("packed").alias("x")), "a").join(packed.select(F.col("id").alias("b"), F.col("packed").alias("y")), "b")

    def run(batches: Batches) -> Batches:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            ids = [batch.column(c).to_numpy() for c in ("a", "b")]
            for own, column in zip(ids, ("x", "y"), strict=True):
                for i, x in zip(own.tolist(), batch.column(column), strict=True):
                    if i not in sets:
                        sets[i] = np.unique(shingle_hashes(unpack(x.as_py()).decode("utf-8"), shingle_words))
            near = [similar(sets[a], sets[b], similarity) for a, b in zip(*(x.tolist() for x in ids), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

    found = written(both.select("a", "b", "x", "y").mapInArrow(frugal(run), "a long, b long"), "similar")
    discard(texts.sparkSession, needed, packed)
    return found


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have that Jaccard similarity; empty ones are equal."""
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= similarity * (len(x) + len(y) - shared)


def _fingerprint_pairs(known: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: each text with the first of its fingerprint, and those of linked fingerprints, unless sizes or parities exclude them."""
    head = F.min_by(F.struct("id", "n", "bits"), "id").alias("head")
    heads = written(known.groupBy("fp").agg(head), "heads")
    own = known.join(heads, "fp").select("head", F.struct("id", "n", "bits").alias("text")).filter("head.id <> text.id")
    near = links(heads, DISTANCE, BLOCKS, spanning=True).distinct()
    one = near.join(heads.select(F.col("fp").alias("a"), "head"), "a").join(heads.select(F.col("fp").alias("b"), F.col("head").alias("text")), "b")
    every = own.unionByName(one.select("head", "text")).select(*(F.col(f"{x}.{c}").alias(f"{c}{i}") for i, x in enumerate(("head", "text")) for c in ("id", "n", "bits")))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            n, m = (batch.column(c).to_pylist() for c in ("n0", "n1"))
            bits, other = ([x.values.to_numpy() for x in batch.column(c)] for c in ("bits0", "bits1"))
            fine = [may_be_similar(*x, similarity) for x in zip(n, bits, m, other, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id0"), batch.column("id1")], names=["a", "b"]).filter(pa.array(fine, pa.bool_()))

    pairs = written(every.mapInArrow(frugal(run), "a long, b long").distinct(), "pairs")
    discard(known.sparkSession, heads)
    return pairs


def _proposals(units: DataFrame, known: DataFrame, roots: DataFrame, similarity: float, lo: int, hi: int) -> DataFrame:
    """``(a, b, unit)``: pairs of different groups that may be similar; in a row without them, a unit that has more to propose.

    Units whose members all are of one group are passed over before anything but numbers is gathered.
    """
    grouped = units.join(roots.withColumnRenamed("id", "linked"), F.col("id") == F.col("linked"), "left").select("unit", "block", "id", F.coalesce("root", "id").alias("group"))
    over = Window.partitionBy("unit")
    mixed = grouped.withColumns({"low": F.min("group").over(over), "high": F.max("group").over(over)}).filter("low < high").drop("low", "high")
    held = mixed.join(known.select("id", "n", "bits"), "id").groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("n", "id", "block", "group", "bits"))).alias("rows"))

    def propose(batches: Batches) -> Batches:
        for batch in batches:
            found, open_units = [np.empty((0, 2), np.int64)], []
            for i, (unit, rows) in enumerate(zip(batch.column("unit").to_pylist(), batch.column("rows"), strict=True)):
                own = rows.values
                n, ids, block, group = (own.field(f).to_numpy(zero_copy_only=False) for f in ("n", "id", "block", "group"))
                bits = [x.values.to_numpy() for x in own.field("bits")]
                a, b, rest = _proposed(n, block, group, bits, similarity, unit["low"] < unit["high"], lo, hi)
                found.append(np.stack([ids[a], ids[b]], 1))
                open_units += [i] * rest
            pairs, units = np.concatenate(found), batch.column("unit").take(pa.array(open_units, pa.int64()))
            for part, kind in ((pairs, "pairs"), (units, "units")):
                if len(part):
                    none = pa.nulls(len(part), pa.int64())
                    columns = [pa.array(part[:, 0]), pa.array(part[:, 1]), pa.nulls(len(part), units.type)] if kind == "pairs" else [none, none, units]
                    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "unit"])

    kind = units.schema["unit"].dataType.simpleString()
    return written(held.mapInArrow(frugal(propose), f"a long, b long, unit {kind}"), "pairs")


def similar_classes(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, key)`` of each row, and ``(key, rep, id, root)`` of the distinct texts: texts of one root are near copies.

    Rows of one text are one class and never paired; key is the text's digest, rep its least doc_id.
    After the fingerprint links, each round verifies pairs that lie in different groups on the shingle
    sets of their whole texts, and the verified links join groups, until no unit has more to propose;
    a dense group costs its members a few pairs each. A group is handed on as its members and their root. Texts without a word are similar to each other.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long"), "text").withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    marks = written(_marks(texts, shingle_words, similarity), "marks")
    first = marks.groupBy("key").agg(F.min("doc_id").alias("rep"), *(F.any_value(c).alias(c) for c in ("n", "fp", "bits", "firsts")))
    classes = written(first.withColumn("id", F.monotonically_increasing_id()), "classes")
    rows = written(marks.select("doc_id", "key"), "rows")
    discard(spark, marks)
    units = written(_shared(classes, similarity), "units")
    known = written(classes.drop("firsts"), "known")
    discard(spark, classes)
    pairs = _fingerprint_pairs(known, similarity)
    linked = _confirmed(pairs, texts, known, shingle_words, similarity)
    discard(spark, pairs)
    roots = written(components(linked), "roots")
    discard(spark, linked)
    lo, hi = 0, FIRST
    while True:
        pairs = _proposals(units, known, roots, similarity, lo, hi)
        if pairs.filter("a is not null").limit(1).count():
            found = _confirmed(pairs.filter("a is not null").select("a", "b").distinct(), texts, known, shingle_words, similarity)
            joined = roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(found)
            after = written(components(joined), "roots")
            discard(spark, found, roots)
            roots = after
        rest = pairs.filter("unit is not null").select("unit")
        if not rest.limit(1).count():
            break
        left = written(units.join(rest, "unit", "left_semi"), "units")
        discard(spark, units, pairs)
        units, lo, hi = left, hi, 16 * hi
    discard(spark, units, pairs)
    member = known.select("key", "rep", "id").join(roots.withColumnRenamed("id", "linked"), F.col("id") == F.col("linked"), "left")
    return rows, member.select("key", "rep", "id", F.coalesce("root", "id").alias("root"))


def one_of_each_group(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The row of the least doc_id of each group of near copies, with all columns of ``docs``.

    A null doc_id comes last within its group. Of rows equal in doc_id and text one stays. An empty
    table gives an empty table. Rows that are surely alone, by a bit map of those with a copy, stay
    where they are; only the others are joined with the rows to keep.
    """
    spark = docs.sparkSession
    rows, member = similar_classes(docs, shingle_words, similarity)
    first = member.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("last"), "rep", "key")).alias("x"), F.count("*").alias("texts")).select(F.col("x.rep").alias("kept_id"), F.col("x.key").alias("kept_key"), "texts", "root")
    counted = rows.groupBy("key").agg(F.count("*").alias("copies"))
    sized = written(member.join(counted, "key").join(first.select("root", "texts"), "root").filter("texts > 1 or copies > 1").select(F.xxhash64("key").alias("h")), "copied")
    kept = written(first.select("kept_id", "kept_key"), "kept")
    bits = spark.sparkContext.broadcast(bit_map(sized))

    @F.pandas_udf("boolean")
    def copied(h: pd.Series) -> pd.Series:
        return pd.Series(marked(bits.value, h.to_numpy()))

    key = F.md5(F.coalesce("text", F.lit("")))
    told = docs.withColumn("has_copy", copied(F.xxhash64(key)))
    alone = told.filter(~F.col("has_copy")).drop("has_copy")
    others = told.filter("has_copy").drop("has_copy").join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (key == F.col("kept_key")))
    return alone.unionByName(others.dropDuplicates(["kept_id", "kept_key"]).drop("kept_id", "kept_key"))
