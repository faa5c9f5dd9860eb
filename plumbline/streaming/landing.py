"""New landed files as a stream: every file once, under the same strict schema as a batch, and no batch twice."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plumbline.sources.landing import audited
from plumbline.sources.sinks import append_once


def land_batch(df: DataFrame, batch: int, target: str, checkpoint: str, run_id: str) -> None:
    """Append one batch of the stream that a checkpoint belongs to; the same batch again replaces itself.

    The stream is known by the identifier in its checkpoint: another checkpoint counts its batches anew and is another source.
    """
    stream = json.loads(df.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    append_once(audited(df, f"{run_id}-{batch}"), target, stream, batch)


def stream_landing(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, run_id: str) -> StreamingQuery:
    """Append the Parquet files that ``source`` has and the checkpoint hasn't seen, then stop."""
    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(lambda df, batch: land_batch(df, batch, target, checkpoint, run_id)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
