"""Incremental loads (C7): resume from the cursor committed by the last load of
the same pipeline; an uncommitted run leaves no state behind.

Beside the cursor, a load commits the boundary (``operators.boundary``): the digests of the loaded source
rows at the cursor and without one, as a Parquet table under ``<dataset>/_boundary`` that the state names.  Rows that
turn up there later are loaded once, whatever the table's nesting, naming or columns.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.contract import TableContract
from tableload.functions.naming import normalize_name
from tableload.operators.boundary import SCHEMA, boundary_of, joined, not_loaded
from tableload.operators.state import incremental, latest_state
from tableload.plans.load import Receipt, load
from tableload.session import scratch_path
from tableload.sources.dataset import BOUNDARY_DIR, Dataset


def _state(ds: Dataset, pipeline: str) -> dict[str, Any]:
    if not ds.exists():
        return {}
    rows = latest_state(ds.states(), ds.loads(), pipeline).collect()
    held = json.loads(rows[0]["state"]) if rows else None
    return held if isinstance(held, dict) else {}


def last_cursor(spark: SparkSession, path: str, pipeline: str, table: str) -> Any:
    """The cursor value the newest committed state of ``pipeline`` holds for
    ``table`` (its name in the dataset); None on a first run or after the dataset was dropped."""
    return _state(Dataset(spark, path), pipeline).get("cursors", {}).get(table)


def incremental_load(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    contract: TableContract,
    cursor: str,
    pipeline: str,
    load_id: str,
    initial: Any = None,
    **load_options,
) -> Receipt:
    """Load the rows of ``source`` newer than the pipeline's committed cursor, and those at the cursor
    or without one that are not loaded yet; commit the new cursor maximum and boundary with the data."""
    ds = Dataset(spark, path)
    done = ds.ledger.receipt(ds.snapshot(), load_id) if ds.exists() else None
    if done is not None:
        return Receipt(load_id, False, done.get("counts", {}), done.get("tables", []))
    table = normalize_name(contract.name, load_options.get("naming", "direct"))
    # a refresh clears the table, so its old cursor no longer bounds the batch
    held = {} if load_options.get("refresh") else _state(ds, pipeline)
    last = held.get("cursors", {}).get(table)
    boundary = held.get("boundaries", {}).get(table)
    bound = last if last is not None else initial
    dtype = source.schema[cursor].dataType
    loaded = _read(spark, ds, boundary)
    batch = source if bound is None else _batch(source, cursor, F.lit(bound).cast(dtype), last is not None, boundary, loaded)
    # read once: the new maximum, the boundary and the loaded rows come from the same files
    staged = f"{scratch_path(spark, 'incremental')}/{table}"
    batch.write.parquet(staged)
    batch = spark.read.schema(source.schema).parquet(staged)
    top = batch.agg(F.max(cursor).cast("string").alias("m")).collect()[0]["m"]
    new = top if top is not None else (str(bound) if bound is not None else None)
    entry = _write(ds, batch, cursor, dtype, new, loaded, boundary, same=new == (None if last is None else str(last)))
    state = {"pipeline_name": pipeline, "state": {"cursors": {table: new}, "boundaries": {table: entry}}}
    receipt = load(spark, path, {contract.name: batch}, [contract], load_id, state=state, **load_options)
    ds.ledger.fs.delete(staged.rsplit("/", 1)[0])
    return receipt


def _batch(source: DataFrame, cursor: str, bound, resumed: bool, boundary: dict | None, loaded: DataFrame | None) -> DataFrame:
    """Rows after ``bound``, and those without a cursor; on a resumed run also rows at the bound.  What the boundary
    holds is taken off."""
    c = F.col(f"`{cursor}`")
    late = source.filter((c == bound) | c.isNull() if resumed else c.isNull())
    if loaded is not None:
        late = not_loaded(late, loaded, boundary["columns"])
    return incremental(source, cursor, bound).unionByName(late)


def _read(spark: SparkSession, ds: Dataset, boundary: dict | None) -> DataFrame | None:
    return spark.read.schema(SCHEMA).parquet(f"{ds.path}/{boundary['path']}") if boundary else None


def _write(ds: Dataset, batch: DataFrame, cursor: str, dtype: T.DataType, bound: str | None, loaded: DataFrame | None,
           boundary: dict | None, same: bool) -> dict:
    """The boundary after this load: what the batch adds, the rows without a cursor loaded before, and those at
    the bound while it stays the same."""
    parts = [boundary_of(batch, cursor, F.lit(bound).cast(dtype))]
    sets = [sorted(batch.columns)]
    if loaded is not None:
        parts.append(loaded if same else loaded.filter(~F.col("on_bound")))
        sets += [c for c in boundary["columns"] if c not in sets]
    name = f"{BOUNDARY_DIR}/{uuid.uuid4().hex}"
    joined(parts).write.parquet(f"{ds.path}/{name}")
    return {"path": name, "columns": sorted(sets, key=lambda c: (-len(c), c))}
