"""Which source rows at an incremental bound were loaded before.

A cursor tells nothing of rows that share its last value, nor of rows without one.  A **boundary** is the
multiset of those rows that are loaded: (columns, digest, on_bound, n), with n equal rows under a digest of the source
row's values in those columns.  It is taken on the source, before naming, nesting or type changes of the table, so
none of these matter; a digest names its columns, so a source that gains columns still recognises its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.functions.keycode import key_code

SCHEMA = "columns array<string>, digest string, on_bound boolean, n long"


def row_digest(schema: T.StructType, columns: Sequence[str]) -> Column:
    """Digest of a row's values in ``columns``; a column the schema lacks counts as NULL."""
    have = {f.name: f.dataType for f in schema.fields}
    values = [F.col(f"`{c}`") if c in have else F.lit(None) for c in columns]
    return F.md5(key_code(values, [have.get(c, T.NullType()) for c in columns]))


def boundary_of(rows: DataFrame, cursor: str, bound: Column) -> DataFrame:
    """The boundary that ``rows`` add: those at ``bound`` and those without a cursor."""
    columns = sorted(rows.columns)
    c = F.col(f"`{cursor}`")
    return rows.filter((c == bound) | c.isNull()).groupBy(
        row_digest(rows.schema, columns).alias("digest"), c.isNotNull().alias("on_bound")).agg(
        F.count(F.lit(1)).alias("n")).select(F.array(*[F.lit(x) for x in columns]).alias("columns"), "digest", "on_bound", "n")


def joined(boundaries: Sequence[DataFrame]) -> DataFrame:
    """One boundary of several; equal rows are counted together."""
    out = boundaries[0]
    for more in boundaries[1:]:
        out = out.unionByName(more)
    return out.groupBy("columns", "digest", "on_bound").agg(F.sum("n").alias("n")).select("columns", "digest", "on_bound", "n")


def not_loaded(late: DataFrame, loaded: DataFrame, column_sets: Sequence[Sequence[str]]) -> DataFrame:
    """``late`` without the rows of the boundary ``loaded``, each as often as it was loaded.
    Equal rows are counted before they are shuffled, so a row that recurs without end stays one
    row a partition.  ``column_sets`` are the boundary's, the widest first: a row is looked for under the
    columns it was loaded with."""
    names = late.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    counted = late.groupBy(row_digest(late.schema, sorted(names)).alias("__whole")).agg(
        F.any_value(row).alias("__row"), F.count(F.lit(1)).alias("__n"))
    row_schema = late.schema
    for columns in column_sets:
        have = {f.name: f.dataType for f in row_schema.fields}
        values = [F.col("__row")[c] if c in have else F.lit(None) for c in columns]
        part = F.md5(key_code(values, [have.get(c, T.NullType()) for c in columns]))
        known = loaded.filter(F.col("columns") == F.array(*[F.lit(c) for c in columns])).groupBy("digest").agg(F.sum("n").alias("__known"))
        counted = counted.withColumn("digest", part).join(known, "digest", "left")
        # rows that differ only in columns they were loaded without share the number that is known, in a fixed order
        before = F.sum("__n").over(Window.partitionBy("digest").orderBy("__whole").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        left = F.least(F.col("__n"), F.greatest(F.lit(0), before - F.coalesce("__known", F.lit(0))))
        counted = counted.withColumn("__n", left).filter("__n > 0").select("__whole", "__row", "__n")
    copies = counted.select("__row", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__copy"))
    return copies.select(*[F.col("__row")[c].alias(c) for c in names])
