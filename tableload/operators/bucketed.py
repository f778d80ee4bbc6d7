"""Merges whose target is never shuffled.

``save_bucketed`` writes a table in ``buckets`` buckets of its key, in the hash that Spark's own joins use.
``merge_bucketed`` deals only the staged rows into the same buckets, after each key was cut to its newest row, and
meets the target bucket by bucket in one full outer join: stale rows, partial columns and deletes are decided there,
so the target is read once and crosses no exchange.  Each task of the join holds one bucket, so saving the result
needs no exchange either and writes one file a bucket.

The tables are external tables of the session's catalog.  A key of the staged side is cast to the stored type, as a
cast on the target's side would cost its buckets.  NULL keys never match: stored rows without a key stay, and the
newest staged one is inserted.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.errors import ContractError
from tableload.functions.types import widen
from tableload.operators.merge import _cols, dedup_latest, deleted_flag, incoming_is_newer


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def save_bucketed(df: DataFrame, path: str, primary_key: Sequence[str] | str, buckets: int) -> DataFrame:
    """``df`` written to the new folder ``path`` in ``buckets`` buckets of the key, and read back."""
    table = f"bucketed_{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").bucketBy(buckets, *_cols(primary_key)).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, primary_key: Sequence[str] | str, buckets: int) -> DataFrame:
    """A folder that ``save_bucketed`` wrote, perhaps in another session.  ``schema`` and ``buckets`` are those
    it was written with."""
    table, keys = f"bucketed_{uuid.uuid4().hex[:12]}", ", ".join(map(_name, _cols(primary_key)))
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({schema.toDDL()}) USING parquet CLUSTERED BY ({keys}) INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    return spark.table(table)


def merge_bucketed(
    target: DataFrame,
    staged: DataFrame,
    primary_key: Sequence[str] | str,
    buckets: int,
    cursor: str | None = None,
    tie_break: Sequence[str] = (),
    *,
    partial: bool = False,
    hard_delete: str | None = None,
) -> DataFrame:
    """The rows of ``target`` (a bucketed table) after ``staged`` was merged into it.

    Per key the newest staged row counts; with a cursor it must beat the stored one.  It replaces the stored row,
    or with ``partial`` only the columns it has, and removes it where ``hard_delete`` says so.  Columns that only
    ``staged`` has are added."""
    pk = _cols(primary_key)
    stored = {f.name: f.dataType for f in target.schema.fields}
    for f in staged.schema.fields:
        if f.name in stored and widen(stored[f.name], f.dataType, f"{f.name}: ") != stored[f.name]:
            raise ContractError(f"{f.name}: a bucketed table keeps its types; write it anew for {f.dataType.simpleString()}")
    live = staged.select(*[F.col(_name(c)).cast(stored[c]).alias(c) if c in stored else F.col(_name(c)) for c in staged.columns])
    live = dedup_latest(live, pk, cursor, tie_break)  # limits each key before it is shuffled
    gone = deleted_flag(live, hard_delete) if hard_delete else F.lit(False)
    live = live.select("*", gone.alias("__gone"), F.lit(True).alias("__staged")).repartition(buckets, *pk)
    t = lambda c: F.col(f"__t.{_name(c)}")
    s = lambda c: F.col(f"__s.{_name(c)}")
    on = t(pk[0]) == s(pk[0])
    for k in pk[1:]:
        on = on & (t(k) == s(k))
    met = target.withColumn("__stored", F.lit(True)).alias("__t").join(live.alias("__s"), on, "full_outer")
    newer = F.lit(True)
    if cursor and cursor in stored:
        newer = incoming_is_newer(s(cursor), t(cursor)) if cursor in staged.columns else F.lit(False)
    wins = s("__staged").isNotNull() & (t("__stored").isNull() | newer)
    columns = []
    for c in stored:
        if c in pk:
            columns.append(F.coalesce(t(c), s(c)).alias(c))
        elif c in staged.columns:
            columns.append(F.when(wins, s(c)).otherwise(t(c)).alias(c))
        else:
            columns.append((t(c) if partial else F.when(~wins, t(c))).alias(c))
    columns += [F.when(wins, s(c)).alias(c) for c in staged.columns if c not in stored and c != hard_delete]
    return met.filter(~(wins & F.coalesce(s("__gone"), F.lit(False)))).select(*columns)
