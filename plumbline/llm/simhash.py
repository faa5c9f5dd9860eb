"""SimHash near-duplicates: 64-bit fingerprints, sharded by vantage-point trees, linked exactly.

A fingerprint is cut into ``blocks`` runs of bits. Two fingerprints that differ in at most ``k``
bits differ in at most ``r = k // blocks`` bits of some block, so each block carries a vantage-point
tree of its own over the Hamming distance within the block, with points of the data as vantage
points. A level of a tree is the ring, the distance to that level's vantage point; by the triangle
bound a point at distance r lies in rings at most r away, so every other branch is pruned. Of the
branches left a point at that distance can only lie in those that flipping up to r bits leads to. A
fingerprint lives in one shard of each tree and is searched for in the shards that its boundary
overlaps and that lie outward at the first level, or level with it: of two points one lies outward.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, frugal, small_batches, texts_of, written
from plumbline.llm.components import components

BITS = 64
#: Levels of a tree, and points of the data among which its vantage points are chosen.
LEVELS, CHOICE = 8, 64

_LANES = np.uint64(0x0101010101010101)
_digest = partial(xxhash.xxh64_intdigest, seed=42)


def shingle_hashes(text: str, shingle_words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of words, repeats included; ASCII letters lower-cased."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - shingle_words + 1)
    if len(words) < shingle_words:
        runs = iter([b" ".join(words)])
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    return np.fromiter(map(_digest, runs), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half the hashes; none: 0."""
    n = len(hashes)
    if not n:
        return 0
    starts = np.arange(0, n, 255)  # a byte lane holds at most 255 ones
    counts = np.empty((8, 8), np.int64)
    for j in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & _LANES, starts)
        counts[:, j] = lanes.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return int(np.packbits(counts.reshape(64) * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``(doc_id, fp)`` for each row of ``docs``; fp is the fingerprint as a signed long.

    Null and empty texts get 0; fewer words than a shingle make one shingle. Extra columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            fps = np.array([majority(shingle_hashes(t, shingle_words)) for t in texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(run), "doc_id long, fp long")


def _span(block: int, blocks: int) -> tuple[int, int]:
    return BITS * block // blocks, BITS * (block + 1) // blocks


def _mask(block: int, blocks: int) -> np.uint64:
    lo, hi = _span(block, blocks)
    return np.uint64(((1 << (hi - lo)) - 1) << lo)


def vantage_points(points: np.ndarray, block: int, blocks: int, levels: int = LEVELS) -> np.ndarray:
    """Points whose distances within the block to those already chosen lie nearest to half its bits: their rings tell most apart."""
    own = np.unique(points & _mask(block, blocks))
    lo, hi = _span(block, blocks)
    chosen = own[:1]
    while 0 < len(chosen) < min(levels, len(own)):
        off = np.abs(2 * np.bitwise_count(own[:, None] ^ chosen[None, :]).astype(np.int64) - (hi - lo)).max(1)
        chosen = np.append(chosen, own[np.argmin(off + 1000 * np.isin(own, chosen))])
    return chosen


def overlapped(fps: np.ndarray, block: int, blocks: int, vantages: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the shards: the home of each fingerprint, and (which, shard) rows of those its boundary overlaps."""
    lo, hi = _span(block, blocks)

    def rings(points: np.ndarray) -> np.ndarray:
        return np.bitwise_count((points[:, None] ^ vantages[None, :]) & _mask(block, blocks)).astype(np.int64)

    def number(r: np.ndarray) -> np.ndarray:
        out = np.full(len(r), block, np.int64)
        for level in range(r.shape[1]):
            out = out * (BITS + 1) + r[:, level]
        return out

    own = rings(fps)
    home, found = number(own), [np.empty((0, 2), np.int64)]
    for n in range(1, radius + 1):
        for places in combinations(range(lo, hi), n):
            moved = rings(fps ^ np.uint64(sum(1 << p for p in places)))
            shard = number(moved)
            ok = (moved[:, 0] >= own[:, 0]) & (shard != home) if len(vantages) else np.zeros(len(fps), bool)
            found.append(np.stack([np.flatnonzero(ok), shard[ok]], 1))
    return home, np.unique(np.concatenate(found), axis=0)


def shards(classes: DataFrame, max_distance: int = 2, blocks: int = 2, levels: int = LEVELS) -> DataFrame:
    """``(shard, fp, probe)``: each fingerprint at home in one shard per tree, probing those its boundary overlaps.

    The vantage points are chosen among the CHOICE fingerprints of least hash; they decide the work only.
    """
    small_batches(classes.sparkSession)
    radius = max_distance // blocks
    drawn = classes.select("fp", F.xxhash64("fp").alias("h")).orderBy("h", "fp").limit(CHOICE).toArrow().column("fp").to_numpy().view(np.uint64)
    trees = [vantage_points(drawn, b, blocks, levels) for b in range(blocks)]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                fps = batch.column("fp").slice(i, 2048).to_numpy().view(np.uint64)
                for b, vantages in enumerate(trees):
                    home, rest = overlapped(fps, b, blocks, vantages, radius)
                    shard, who = np.concatenate([home, rest[:, 1]]), np.concatenate([fps, fps[rest[:, 0]]])
                    yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(who.view(np.int64)), pa.array(np.arange(len(shard)) >= len(home))], names=["shard", "fp", "probe"])

    return classes.select("fp").mapInArrow(frugal(run), "shard long, fp long, probe boolean")


def _star_edges(home: np.ndarray, probes: np.ndarray, most: int) -> np.ndarray:
    """Links that span what a shard holds: each point to the first point of its group. Never all pairs."""
    points = np.unique(np.concatenate([home, probes])) if len(probes) else home
    left, edges = points, []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        front = [seed]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= most
            if near.any():
                found = left[near]
                edges += [(seed, x) for x in found]
                front += list(found)
                left = left[~near]
    return np.array(edges, np.uint64).reshape(-1, 2)


def _all_edges(home: np.ndarray, probes: np.ndarray, most: int) -> np.ndarray:
    """Every link between a home point and another point of the shard, in blocks of bounded memory."""
    others, edges = np.concatenate([home, probes]), []
    step = max(1, 4_000_000 // max(1, len(others)))
    for i in range(0, len(home), step):
        a, b = np.nonzero(np.bitwise_count(home[i : i + step, None] ^ others[None, :]) <= most)
        edges.append(np.stack([home[i + a], others[b]], 1))
    found = np.concatenate(edges) if edges else np.empty((0, 2), np.uint64)
    found = np.sort(found[found[:, 0] != found[:, 1]], 1)
    return np.unique(found, axis=0)


def links(classes: DataFrame, max_distance: int = 2, blocks: int = 2, levels: int = LEVELS, spanning: bool = False) -> DataFrame:
    """``(a, b)`` of distinct fingerprints (column fp) that differ in at most ``max_distance`` bits.

    ``spanning``: only enough links to keep each group connected, at most one per point and shard;
    otherwise all of them, once each, a < b unsigned. Exact for every ``max_distance`` and ``blocks``.
    """
    held = shards(classes, max_distance, blocks, levels).groupBy("shard").agg(
        F.collect_list(F.when(~F.col("probe"), F.col("fp"))).alias("home"), F.collect_list(F.when(F.col("probe"), F.col("fp"))).alias("probes")
    ).filter((F.size("home") > 0) & (F.size("home") + F.size("probes") > 1))
    find = _star_edges if spanning else _all_edges

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = [np.empty((0, 2), np.uint64)]
            for home, probes in zip(batch.column("home"), batch.column("probes"), strict=True):
                out.append(find(*(np.sort(x.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) for x in (home, probes)), max_distance))
            pairs = np.concatenate(out).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    found = held.select("home", "probes").mapInArrow(frugal(run), "a long, b long")
    return found if spanning else found.distinct()


def near_groups(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2, blocks: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the least doc_id among all documents whose fingerprints are reached over links
    of at most ``max_distance`` bits. Copies share a fingerprint and are one class, so a group of
    copies is never expanded into pairs. Rows with a null doc_id keep their row and are passed over
    when the least id is sought. An empty table gives an empty table.
    """
    fps = written(fingerprints(docs, shingle_words), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(links(classes, max_distance, blocks, spanning=True))
    rooted = classes.join(roots, classes.fp == roots.id, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    known = written(rooted.join(least, "root").select("fp", "component_id"), "membership")
    return fps.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
