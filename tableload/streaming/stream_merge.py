"""Structured Streaming into a dataset.

Each micro-batch is one load with id ``<query>-<checkpoint's own id>-<batchId>``
(fixed width), so a batch replayed after a failure finds its receipt and is a no-op:
exactly-once publication on top of the at-least-once ``foreachBatch`` sink.  The id that
Spark keeps in the checkpoint tells a query restarted with a new checkpoint, whose batch
numbers begin again, from a replay.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tableload.contract import TableContract
from tableload.plans.load import load
from tableload.session import shared_dir
from tableload.sources.fs import FS


def batch_load_id(query_name: str, stream_id: str, batch_id: int) -> str:
    return f"{query_name}-{stream_id}-{batch_id:012d}"


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query when it made the checkpoint."""
    return json.loads(FS(spark, checkpoint).read(f"{checkpoint.rstrip('/')}/metadata"))["id"]


def stream_merge(
    stream: DataFrame,
    path: str,
    contracts: Sequence[TableContract],
    query_name: str,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    **load_options,
) -> StreamingQuery:
    """Start a streaming query applying every micro-batch to the dataset at ``path``
    with the contracts' dispositions (merge, append or replace)."""
    root = next(c for c in contracts if c.parent is None)
    spark = stream.sparkSession
    cp = checkpoint or f"{shared_dir(spark).rstrip('/')}/streams/{query_name}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream_id = checkpoint_id(spark, cp)
        load(batch.sparkSession, path, {root.name: batch}, contracts, batch_load_id(query_name, stream_id, batch_id),
             **load_options)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", cp).queryName(query_name)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
