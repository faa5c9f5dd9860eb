"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, drawn, frugal, remainder, small_batches

#: Hashed words, then the statistics, each an input of the machine.
WORD_INPUTS = 1 << 15
STATISTICS = 16
RANK = 6
#: Labelled rows learned from at most: those with the least hash of doc_id. Drawn before any text is read.
MAX_TRAIN = 6_000
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.08, 1e-5

SYMBOLS = re.compile(r"[^\w\s]")
MARKED = re.compile(r"[^\w\s]{2,}(?=\s|\Z)")


def statistics(text: str, words: list[str], counts: Counter, n_chars: int | None) -> list[float]:
    """Shares between 0 and about 1 that describe a text's make-up, and its recorded length as metadata."""
    n, length = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    unique = len(counts) / n
    return [
        1.0,
        math.log1p(len(words)) / 10,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isdigit, text)) / length,
        len(SYMBOLS.findall(text)) / length * 4,
        len(MARKED.findall(text)) / n,
        text.count("|") / n,
        unique,
        unique if len(words) < 50 else 0.0,
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(lines)) / max(1, len(lines)),
        min(2.0, length / n / 10),
        text.count("\n") / n * 2,
        0.0 if n_chars is None else math.log1p(max(0, n_chars)) / 12,
        float(n_chars is None),
    ]


_places: dict[str, int] = {}


def place(word: str) -> int:
    """Input of a word, lower-cased; remembered by the worker up to a bound."""
    got = _places.get(word)
    if got is None:
        if len(_places) > 200_000:
            _places.clear()
        got = _places[word] = xxhash.xxh32_intdigest(word.lower()) % WORD_INPUTS
    return got


def inputs(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a document's non-zero inputs; word values have length 1 together."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    at = np.fromiter(map(place, counts), np.int32, len(counts))
    value = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    value /= max(1e-9, float(np.sqrt((value * value).sum())))
    stats = statistics(text, words, counts, n_chars)
    return np.concatenate([at, WORD_INPUTS + np.arange(STATISTICS, dtype=np.int32)]), np.concatenate([value, stats])


@dataclass
class FactorizationMachine:
    """``bias + sum w x + (sum of squares of sums - sums of squares) / 2`` over the columns of ``factors``."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, at: np.ndarray, value: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and each row's sums; ``rows`` names the row of each input."""
        linear = np.bincount(rows, self.weights[at] * value, n)
        terms = self.factors[at] * value[:, None]
        sums = np.stack([np.bincount(rows, terms[:, f], n) for f in range(terms.shape[1])], 1)
        squares = np.bincount(rows, (terms * terms).sum(1), n)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def scores(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        at, value, rows = _stack(docs)
        return 1 / (1 + np.exp(-np.clip(self.raw(at, value, rows, len(docs))[0], -40, 40)))


def _stack(docs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(a) for a, _ in docs]
    return np.concatenate([a for a, _ in docs]), np.concatenate([v for _, v in docs]), np.repeat(np.arange(len(docs)), sizes)


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 3) -> FactorizationMachine:
    """Logistic loss by AdaGrad over mini-batches in a fixed order."""
    rng, size = np.random.default_rng(seed), WORD_INPUTS + STATISTICS
    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    m = FactorizationMachine(math.log(share / (1 - share)), np.zeros(size), rng.normal(0, 0.05, (size, RANK)))
    gw, gv, gb = np.full(size, 1e-3), np.full((size, RANK), 1e-3), 1e-3
    for _ in range(EPOCHS if len(docs) else 0):
        order = rng.permutation(len(docs))
        for i in range(0, len(docs), BATCH):
            own = order[i : i + BATCH]
            at, value, rows = _stack([docs[j] for j in own])
            score, sums = m.raw(at, value, rows, len(own))
            error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - labels[own]) / len(own)
            e = error[rows] * value
            used, back = np.unique(at, return_inverse=True)
            dw = np.bincount(back, e, len(used)) + DECAY * m.weights[used]
            slope = e[:, None] * (sums[rows] - m.factors[at] * value[:, None])
            dv = np.stack([np.bincount(back, slope[:, f], len(used)) for f in range(RANK)], 1) + DECAY * m.factors[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += error.sum() ** 2
            m.weights[used] -= RATE * dw / np.sqrt(gw[used])
            m.factors[used] -= RATE * dv / np.sqrt(gv[used])
            m.bias -= RATE * error.sum() / math.sqrt(gb)
    return m


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> FactorizationMachine:
    """Learn ``labels.quality`` from ``docs`` (doc_id, text, n_chars), both as given: withhold rows before.

    Null labels and labels without a document are passed over; of several labels of one document the
    lower counts. If there are more than about ``max_train``, those with the least hash of doc_id
    are used, so the join reads their texts alone and the driver gets a bounded number of rows: one for
    each doc_id, that of the least text if it repeats.
    """
    small_batches(docs.sparkSession)
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(drawn(F.xxhash64("doc_id"), max_train, known.count()))
    rows = docs.select("doc_id", "text", F.col("n_chars").cast("long")).join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct("text", "n_chars")).alias("x")).select("doc_id", "quality", "x.*")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            made = [inputs(t, c) for t, c in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int32()), pa.array([a.tobytes() for a, _ in made], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in made], pa.binary())], names=["doc_id", "quality", "at", "value"])

    got = rows.select(F.col("doc_id").cast("long"), "text", "n_chars", "quality").mapInArrow(frugal(run), "doc_id long, quality int, at binary, value binary").toArrow()
    ordered = sorted(zip(*(got.column(c).to_pylist() for c in ("doc_id", "at", "value", "quality")), strict=True))
    return train([(np.frombuffer(a, np.int32), np.frombuffer(v, np.float32).astype(np.float64)) for _, a, v, _ in ordered], np.array([q > 0 for *_, q in ordered], float))


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on). All columns of ``docs`` are kept, but for such named score or predicted, which the new ones replace.

    Null and empty texts are scored by their statistics. The model has a fixed size and is broadcast.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [n for n in docs.columns if n not in ("score", "predicted")]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("row")
            made = [inputs(t, c) for t, c in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows, pa.array(shared.value.scores(made), pa.float64())], names=["row", "score"])

    inner = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("row"), "text", F.col("n_chars").cast("long").alias("n_chars"))
    kind = inner.schema["row"].dataType.simpleString()
    scored = inner.mapInArrow(frugal(run), f"row {kind}, score double")
    return scored.select("row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def may_learn(table: DataFrame) -> DataFrame:
    """The rows that aren't held out: crc32(doc_id) mod 3 is not 1."""
    return table.filter(remainder("doc_id", 3) != 1)


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``; an empty table gives an empty one.

    Without any label to learn from, every document gets the score of an even guess.
    """
    model = fit(may_learn(docs), may_learn(labels))
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return score(docs.select(F.col("doc_id").cast("long"), "text", "n_chars"), model).select("doc_id", held.alias("held_out"), "score", "predicted")
