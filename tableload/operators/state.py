"""Load receipts, schema history, pipeline state and incremental cursors
as DataFrame operations over the bookkeeping tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableload.operators.merge import dedup_latest

COMMITTED = 0


def new_schema_versions(stored: DataFrame, incoming: DataFrame, hash_col: str = "version_hash") -> DataFrame:
    """C4: schema versions whose hash is not stored yet (insert-if-absent)."""
    return incoming.join(stored.select(hash_col), hash_col, "left_anti")


def latest_schema(
    versions: DataFrame,
    schema_name: str | None = None,
    version_hash: str | None = None,
    order: Sequence[str] = ("inserted_at", "version"),
) -> DataFrame:
    """Newest stored schema, optionally of one name or one hash.  ``limit(1)``
    after ``orderBy`` plans as a top-1 (``TakeOrderedAndProject``): each task keeps
    one candidate, nothing is sorted globally."""
    df = versions
    if schema_name is not None:
        df = df.filter(F.col("schema_name") == schema_name)
    if version_hash is not None:
        df = df.filter(F.col("version_hash") == version_hash)
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(1)


def latest_schema_per_name(versions: DataFrame, order: Sequence[str] = ("inserted_at", "version")) -> DataFrame:
    """Newest schema of every schema name, as one aggregation."""
    return dedup_latest(versions, "schema_name", order[0], list(order[1:]))


def committed_states(states: DataFrame, loads: DataFrame, load_col: str = "_load_id") -> DataFrame:
    """States whose load has a committed receipt (inner join on the load id)."""
    ok = loads.filter(F.col("status") == COMMITTED).select(F.col("load_id").alias(load_col)).distinct()
    return states.join(ok, load_col, "inner")


def latest_state(states: DataFrame, loads: DataFrame, pipeline: str) -> DataFrame:
    """The newest committed state of one pipeline (load ids are fixed width,
    so text order is load order); uncommitted states are never restored."""
    return (committed_states(states, loads).filter(F.col("pipeline_name") == pipeline)
            .orderBy(F.col("_load_id").desc()).limit(1))


def latest_state_per_pipeline(states: DataFrame, loads: DataFrame) -> DataFrame:
    return dedup_latest(committed_states(states, loads), "pipeline_name", "_load_id")


def max_cursor(df: DataFrame, column: str) -> Column:
    """Scalar subquery for the largest cursor value (evaluated once, not a join)."""
    return df.select(F.max(column)).scalar()


def incremental(df: DataFrame, column: str, last: object | Column | None) -> DataFrame:
    """Rows strictly after the last committed cursor (all rows on a first run)."""
    if last is None:
        return df
    bound = last if isinstance(last, Column) else F.lit(last)
    return df.filter(F.col(column) > bound)
