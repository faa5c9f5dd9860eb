"""A training corpus in five stages, each written as Parquet before the next one reads it.

Every stage applies one operator of ``plumbline.llm`` to all that its predecessor kept. A stage's output is
written before the next stage is called: that one first deletes the intermediate tables of its predecessor.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import bpe, mixing, quality, secrets, simgroups
from plumbline.llm.common import discard, documents, scratch_of, shared_path, tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Intermediate tables by session and number of the stage that made them last.
_made: dict[tuple[str, int], list[str]] = {}


def stage(number: int) -> Callable[[Stage], Stage]:
    """Mark the stage of a number: tables of the one before go, its own are noted."""

    def marked(function: Stage) -> Stage:
        @wraps(function)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            session, before = spark.sparkContext.applicationId, set(scratch_of(spark))
            discard(spark, *_made.pop((session, number - 1), []))
            out = function(spark, docs, sf_dir)
            _made[session, number] = [p for p in scratch_of(spark) if p not in before]
            return out

        return run_stage

    return marked


@stage(1)
def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels, predicts as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(quality.may_learn(docs), quality.may_learn(labels))
    return quality.score(docs.select(COLUMNS), model).filter("predicted = 1").select(COLUMNS)


@stage(2)
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of near copies."""
    return simgroups.one_of_each_group(docs.select(COLUMNS))


@stage(3)
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return secrets.redacted(docs.select(COLUMNS), secrets.trained(docs))


@stage(4)
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: some not at all, some more than once."""
    return mixing.mixed_documents(docs.select(COLUMNS))


@stage(5)
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return bpe.encode(docs, tokenizer_file("word_bpe_49k.json"), "digests")


STAGES = [
    ("quality classifier", classify_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

#: No SQL: the classifier is a trained model. Tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, apply in STAGES[:-1]:
        path = shared_path(spark, "stage")
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
