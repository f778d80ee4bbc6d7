"""Read-back helpers (R2, R4-R6) on top of DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {
    "eq": lambda c, v: c == v, "ne": lambda c, v: c != v,
    "gt": lambda c, v: c > v, "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)), "not_in": lambda c, v: ~c.isin(list(v)),
    "like": lambda c, v: c.like(v), "is_null": lambda c, v: c.isNull(),
    "is_not_null": lambda c, v: c.isNotNull(),
}


def where(df: DataFrame, column: str | Column, op: str | None = None, value: object = None) -> DataFrame:
    """``where("id", "gte", 3)`` or ``where(column_expr)``."""
    if op is None:
        return df.filter(column if isinstance(column, Column) else F.expr(column))
    c = F.col(column) if isinstance(column, str) else column
    try:
        return df.filter(_OPS[op](c, value))
    except KeyError:
        raise ValueError(f"unknown operator {op!r}; use one of {sorted(_OPS)}") from None


def arrow_chunks(df: DataFrame, chunk_size: int) -> DataFrame:
    """``df`` as Arrow IPC streams made on the executors: rows (part, n_rows, chunk), in the order of ``df``.
    Within a partition every chunk but the last holds ``chunk_size`` rows.  Columns are numbered, so
    duplicate names do not clash; a task holds one chunk and one of Spark's own batches."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        size = 0

        def packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(rows).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([len(table)], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["part", "n_rows", "chunk"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, chunk_size - size)
                held.append(piece)
                at, size = at + piece.num_rows, size + piece.num_rows
                if size == chunk_size:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(cut, "part int, n_rows long, chunk binary")


def read_chunk(chunk: bytes) -> pa.Table:
    """The rows of one chunk; its columns are numbered."""
    return pa.ipc.open_stream(pa.py_buffer(chunk)).read_all()


def iter_arrow(df: DataFrame, chunk_size: int) -> Iterator[pa.Table]:
    """Arrow tables of ``chunk_size`` rows (the last may be shorter), pulled one partition at a time.  Executors
    ship whole chunks; the driver only joins the ends of partitions, and holds a chunk, the partition
    it comes from and the next one.  Columns are taken by position, so duplicate names survive.  For results
    that do not belong on one machine, write Parquet instead."""
    schema = arrow_schema(df)
    held: list[pa.Table] = []
    size = 0
    for row in arrow_chunks(df, chunk_size).select("chunk").toLocalIterator(prefetchPartitions=True):
        table, at = read_chunk(bytes(row[0])), 0
        table = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(table.columns, schema, strict=True)], schema=schema)
        while at < len(table):
            piece = table.slice(at, chunk_size - size)
            held.append(piece)
            at, size = at + len(piece), size + len(piece)
            if size == chunk_size:
                yield pa.concat_tables(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def arrow_schema(df: DataFrame) -> pa.Schema:
    """The Arrow schema Spark uses for ``df`` (typed even for an empty result)."""
    return df.limit(0).toArrow().schema


def fetchmany(df: DataFrame, n: int) -> list:
    return df.take(n)


def fetchone(df: DataFrame):
    rows = df.take(1)
    return rows[0] if rows else None
