"""Destructive refreshes (C8 C9) on table contents."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def children_of(names: Iterable[str], parents: dict[str, str | None]) -> list[str]:
    """The named tables and, recursively, their child tables."""
    out = list(dict.fromkeys(names))
    i = 0
    while i < len(out):
        out += [t for t, p in parents.items() if p == out[i] and t not in out]
        i += 1
    return out


def drop_data(spark: SparkSession, tables: dict[str, DataFrame], selected: Sequence[str],
              parents: dict[str, str | None] | None = None) -> dict[str, DataFrame]:
    """``drop_data``: selected tables and their children become empty relations
    with their schema; other tables are untouched; absent names are tolerated."""
    clear = set(children_of([s for s in selected if s in tables], parents or {}))
    return {name: (spark.createDataFrame([], df.schema) if name in clear else df)
            for name, df in tables.items()}
