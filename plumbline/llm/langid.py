"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, drawn, remainder, small_batches

ORDERS = (1, 2, 3)
DIM = 1 << 16
#: Odd multipliers of the n-gram hash, one per character of the n-gram.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: Training rows of a language: a bounded, hash-drawn sample of those that may be learned from; rare languages give all.
MAX_TRAIN = 5_000
#: Languages of a model at most: its matrix of 65,536 numbers each goes to every worker, 128 MB at this bound. More raise.
MAX_LANGUAGES = 512
#: N-grams looked up at a time.
BLOCK = 1 << 19


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def characters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; all that aren't letters become one space between words, and one at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.concatenate([[32], np.where(_letters()[points], points, 32), [32]]).astype(np.uint32)
    return points[(points != 32) | np.concatenate([[True], points[:-1] != 32])]


def buckets(points: np.ndarray) -> np.ndarray:
    """Hash buckets of all n-grams of all orders."""
    out = []
    for n in ORDERS:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, n, np.uint32)
            for i in range(n):
                h = (h ^ points[i : len(points) - n + 1 + i]) * np.uint32(MULTIPLIERS[i])
                h ^= h >> np.uint32(15)
            out.append(h & np.uint32(DIM - 1))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


@dataclass
class LanguageModel:
    """``weights[bucket, language]``: log probability of an n-gram; ``prior``: log share of the languages."""

    languages: list[str]
    weights: np.ndarray
    prior: np.ndarray

    def scores(self, text: str) -> np.ndarray | None:
        """Log probability per language, or None if the text has no letter."""
        points = characters(text)
        if not (points != 32).any():
            return None
        total, grams = self.prior.astype(np.float64), buckets(points)
        for i in range(0, len(grams), BLOCK):
            total = total + np.take(self.weights, grams[i : i + BLOCK], axis=0).sum(0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        total = self.scores(text) if text and self.languages else None
        if total is None:
            return "und", 0.0
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def fit(labelled: DataFrame, smoothing: float = 0.5, max_train: int = MAX_TRAIN) -> LanguageModel:
    """Learn from ``(doc_id, text, lang)``; rows with a null text or lang are passed over.

    Of a language with more than about ``max_train`` rows those with the least hash are used.
    Counts are summed by Spark; the driver gets at most one number per language and bucket. More than
    MAX_LANGUAGES different values of lang raise: such a column holds something else.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    h = F.xxhash64("doc_id", F.xxhash64("text"))
    chosen = F.lit(False)
    known = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn, such as {sorted(r.lang for r in known)[:3]}")
    for lang, n in known:
        chosen = chosen | ((F.col("lang") == lang) & drawn(h, max_train, n))
    rows = rows.filter(chosen)

    def run(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(DIM, np.int64))
                own += np.bincount(buckets(characters(text)), minlength=DIM)
                docs[lang] = docs.get(lang, 0) + 1
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(own[at], docs[lang]), pa.int64())], names=["lang", "bucket", "n"])

    sums = rows.select("text", "lang").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toArrow()
    names = np.array(got.column("lang").to_pylist(), object)
    bucket, number = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    languages = sorted(set(names))
    counts, docs = np.zeros((DIM, len(languages))), np.ones(len(languages))
    for j, lang in enumerate(languages):
        own = names == lang
        counts[bucket[own & (bucket >= 0)], j] = number[own & (bucket >= 0)]
        docs[j] = number[own & (bucket < 0)][0]
    weights = np.log((counts + smoothing) / (counts.sum(0) + smoothing * DIM)) if languages else counts
    return LanguageModel(languages, weights.astype(np.float32), np.log(docs / docs.sum()))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row: ``und`` and 0.0 if the text is null or has no letter.

    The score is the posterior probability. The model, of fixed size per language, is broadcast.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from rows whose crc32(doc_id) mod 4 is not 2, applied to all.

    A null doc_id is neither held out nor learned from. Texts alone are scored. An empty table, or
    one without a language to learn, gives ``und`` throughout.
    """
    model = fit(docs.filter(remainder("doc_id", 4) != 2))
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
