"""Newest rows of a stream by keyed state.

``newest_rows`` lets through, of every micro-batch, the newest row of each key, and only if it is newer than
all rows of the key before it.  The cursor let through last is kept per key in the state store
(``transformWithState``), so stale and late rows go without a read of the target.  The rules are those of
``dedup_latest`` and ``drop_stale``: NULL cursors are lowest, within a micro-batch ties fall to the tie-break columns and then
to the row's other values (by their JSON text), and a row whose cursor equals the stored one loses.  Rows with a NULL in the key are a key of their own.

Keys and cursors are compared by their canonical codes, written by Spark.  A key that holds a large share
of the rows crosses the shuffle once per Arrow batch, as every batch passes on its newest row of a key.  The state
holds one code per key.

The state knows what this stream has let through, and what ``known`` holds when its checkpoint is made; the stream must be the
only writer of its target.  The cursor of a key outlives a hard delete, so a row older than the delete stays out.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tableload.contract import TableContract
from tableload.functions.keycode import key_code
from tableload.streaming.stream_merge import stream_merge

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY, CURSOR, ORDER = "__key", "__cursor", "__order"


class _Newest(StatefulProcessor):
    """State of a key: the code of the newest cursor let through (a NULL cursor has the lowest code)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._cursor = handle.getValueState("cursor", "cursor string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if not self._cursor.exists() or initialState[CURSOR] > self._cursor.get()[0]:
            self._cursor.update((initialState[CURSOR],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        newest = max(rows, key=lambda row: row[ORDER], default=None)
        if newest is not None and (not self._cursor.exists() or newest[CURSOR] > self._cursor.get()[0]):
            self._cursor.update((newest[CURSOR],))
            yield newest

    def close(self) -> None:
        pass


def _newest_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch, one row of the highest order per key."""
    for batch in batches:
        if batch.num_rows < 2:
            yield batch
            continue
        codes = pa.table({KEY: batch.column(KEY), ORDER: batch.column(ORDER), "at": pa.array(range(batch.num_rows), pa.int64())})
        ordered = codes.take(pc.sort_indices(codes, [(KEY, "ascending"), (ORDER, "ascending")]))
        keys = ordered.column(KEY).combine_chunks()
        last = pc.or_kleene(pc.not_equal(keys.slice(0, len(keys) - 1), keys.slice(1)), False)
        last = pa.concat_arrays([last.combine_chunks() if isinstance(last, pa.ChunkedArray) else last, pa.array([True])])
        yield batch.take(ordered.column("at").filter(last).combine_chunks())


def _code(df: DataFrame, columns: Sequence[str]) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    return key_code([F.col("`" + c.replace("`", "``") + "`") for c in columns], [types[c] for c in columns])


def newest_rows(stream: DataFrame, primary_key: Sequence[str], cursor: str, tie_break: Sequence[str] = (),
                known: DataFrame | None = None) -> DataFrame:
    """The rows of a stream that are newer than all rows of their key before them, one per key and micro-batch.
    ``known`` (a batch table with the key and the cursor) fills the state of a new checkpoint."""
    columns = stream.columns
    rest = [c for c in columns if c not in (*primary_key, cursor, *tie_break)]
    others = F.to_json(F.struct(*["`" + c.replace("`", "``") + "`" for c in rest])) if rest else F.lit("")
    coded = stream.withColumns({KEY: _code(stream, list(primary_key)), CURSOR: _code(stream, [cursor]),
                                ORDER: F.concat(_code(stream, [cursor, *tie_break]), others)})
    first = coded.mapInArrow(_newest_of_batches, coded.schema)
    state = None
    if known is not None:
        types = {f.name: f.dataType for f in stream.schema.fields}
        held = known.select(*[F.col(c).cast(types[c]).alias(c) for c in [*primary_key, cursor]])
        state = held.select(_code(held, list(primary_key)).alias(KEY), _code(held, [cursor]).alias(CURSOR)).groupBy(KEY).agg(
            F.max(CURSOR).alias(CURSOR)).groupBy(KEY)
    schema = T.StructType(list(coded.schema.fields))
    return first.groupBy(KEY).transformWithState(_Newest(), schema, "Append", "None", initialState=state).select(
        *["`" + c.replace("`", "``") + "`" for c in columns])


def stream_merge_newest(stream: DataFrame, path: str, contract: TableContract, query_name: str, *,
                        known: DataFrame | None = None, **options) -> StreamingQuery:
    """``stream_merge`` of a flat table whose stale rows were dropped by state: the merge compares no cursors.
    A micro-batch replayed after a failure meets the state of before it, lets the same rows through and is a no-op."""
    if contract.disposition != "merge" or not contract.cursor or contract.parent is not None:
        raise ValueError("a root table with disposition merge and a cursor is needed")
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # the query keeps the settings it starts with
    try:
        rows = newest_rows(stream, contract.primary_key, contract.cursor, contract.tie_break, known)
        return stream_merge(rows, path, [dataclasses.replace(contract, cursor=None)], query_name, **options)
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
