"""Operator 10, token-id output: files of entropy-coded id blocks.

``write_tokens`` range-partitions the documents by id, encodes them in ascending order with
a public tokenizer, appends the end id, and writes segments of whole documents.  A segment
is coded by ``id_coder``: independently reset, checksummed blocks.  Spark's Parquet
writer carries the segments, one row each, with the ids and token counts of their
documents; so a lost task leaves no part of a file behind, and any store will do.

``read_tokens`` decodes the files again, checks every block, and returns the documents with
their place in the whole stream: the sum of all segments before (a prefix sum over
partitions and over the segments of each) plus the place in the segment.

Defined results: a null or empty text is the end id alone; null ids come first; rows that
share an id follow each other by text hash; an empty table gives no rows; a document longer
than a segment makes a segment of its own; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableload.llm.id_coder import decode_segment, encode_segment
from tableload.llm.ship import ship
from tableload.llm.text import documents
from tableload.llm.tokens import encoder
from tableload.session import scratch_path

END_ID = 1
SEGMENT_IDS = 6_000_000
LANES, LEAST_BLOCK, MOST_BLOCK = 1024, 256, 2048  # blocks are coded side by side
SEGMENTS = "part int, segment int, n_ids long, doc_ids array<long>, doc_tokens array<long>, payload binary"


def _block(ids: int) -> int:
    return min(MOST_BLOCK, max(LEAST_BLOCK, -(-ids // LANES)))


def _encode(tokenizer: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, segment = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], dtype="<u4").tobytes()
        held: list[bytes] = []
        names: list[int | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            lists = [pa.array([names], pa.list_(pa.int64())), pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)], pa.int64()), *lists,
                 pa.array([encode_segment(ids, _block(len(ids)))], pa.binary())],
                names=["part", "segment", "n_ids", "doc_ids", "doc_tokens", "payload"])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at in range(0, len(doc_ids), 500):
                for doc_id, raw in zip(doc_ids[at:at + 500], enc.encode(batch.column(1).slice(at, 500).to_pylist()), strict=True):
                    held.append(raw + end)
                    names.append(doc_id)
                    size += len(raw) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield flush()
                        held, names, size, segment = [], [], 0, segment + 1
        if held:
            yield flush()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, partitions: int | None = None) -> None:
    """Files of all documents' ids, ascending by doc_id.  ``tokenizer``: path of a tokenizers file."""
    spark = docs.sparkSession
    ship(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = documents(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = base.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered.mapInArrow(_encode(tokenizer), SEGMENTS).write.parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            part, segment, names, tokens, payload = (batch.column(c)[r].as_py() for c in range(5))
            ids = decode_segment(payload)
            ends = np.cumsum(np.array(tokens, dtype=np.int64))
            if len(ids) != (ends[-1] if len(ends) else 0):
                raise ValueError("a segment's documents do not add up to its ids")
            starts = ends - np.array(tokens, dtype=np.int64)
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([segment] * n, pa.int32()), pa.array(names, pa.int64()),
                 pa.array(starts, pa.int64()), pa.array(tokens, pa.int64()), pa.array(crcs, pa.int64())],
                names=["part", "segment", "doc_id", "place", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    ship(spark)
    files = spark.read.schema(SEGMENTS).parquet(path)
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per file part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "segment", (F.col("base") + F.col("inside")).alias("offset"))
    # a segment is a large row of work: a few of them at a time in a batch, and tasks of their own
    rows = files.select("part", "segment", "doc_ids", "doc_tokens", "payload").mapInArrow(
        _decode, "part int, segment int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return rows.join(offsets, ["part", "segment"]).select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the files below the shared folder and reads them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)
