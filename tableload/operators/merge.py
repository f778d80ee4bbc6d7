"""Merge family (U1-U12): pure DataFrame -> DataFrame functions, no I/O.

Every function only declares a logical plan; Catalyst prunes columns, pushes the
filters into the Parquet scans and AQE picks the join strategy at run time.  The
joins are equi-joins on the primary key, so at scale each one is a single
hash-partitioned shuffle (or a broadcast of the staged side when AQE measures it
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``).  The wide target is
never shuffled whole for a full-record upsert: it only meets the staged *keys*
through anti/semi joins, which is also how copy-on-write finds touched files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.functions.lineage import LINEAGE, ROOT_ID, ROW_ID


def _cols(names: Sequence[str] | str | None) -> list[str]:
    if names is None:
        return []
    if isinstance(names, str):
        return [names]
    return list(names)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType,)) or type(dt).__name__ == "VariantType":
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


# --------------------------------------------------------------------------- U1
def union_staged(
    frames: Sequence[DataFrame],
    schema: T.StructType | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """All staged frames of one table unioned by column name; a column missing
    from a frame becomes NULL.  With no frame the result is an empty relation of
    ``schema`` (the target's schema)."""
    frames = list(frames)
    if not frames:
        if schema is None or spark is None:
            raise ValueError("union_staged of no frames needs a schema and a session")
        return spark.createDataFrame([], schema)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


# --------------------------------------------------------------------------- U2
def dedup_latest(
    df: DataFrame,
    primary_key: Sequence[str] | str,
    cursor: str | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per primary key: the highest ``cursor`` (NULL lowest, i.e.
    ``DESC NULLS LAST``), then the highest ``tie_break`` columns.

    Planned as ``row_number() = 1``: Spark limits each key to one row before the
    shuffle (``WindowGroupLimit``), so a key holding a third of all staged rows still
    ships one row per input partition.  Exact ties fall back to the row values, so the
    result is deterministic."""
    pk = _cols(primary_key)
    values = [c for c in df.columns if c not in pk]
    if not values:
        return df.select(*pk).distinct()
    order = ([cursor] if cursor and cursor in df.columns else []) + [c for c in tie_break if c in df.columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    order += [c for c in values if c not in order and _orderable(types[c])]
    quoted = ["`" + c.replace("`", "``") + "`" for c in order]
    latest = Window.partitionBy(*pk).orderBy(*[F.col(c).desc_nulls_last() for c in quoted] or [F.lit(0)])
    return df.withColumn("__n", F.row_number().over(latest)).filter("__n = 1").drop("__n")


# --------------------------------------------------------------------------- U3
def key_guard(df: DataFrame, primary_key: Sequence[str] | str) -> DataFrame:
    """One row ``(n_rows, n_keys)``: staged roots of a nested upsert must be unique
    per key.  ``struct`` makes a key with a NULL part count as a distinct key."""
    pk = _cols(primary_key)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.struct(*pk)).alias("n_keys"),
    )


def duplicate_keys(df: DataFrame, primary_key: Sequence[str] | str) -> DataFrame:
    """Keys that occur more than once (empty = the guard passes)."""
    pk = _cols(primary_key)
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


DUPLICATE_KEY = "two rows of one load share a key"


def unique_keys(df: DataFrame, primary_key: Sequence[str] | str) -> DataFrame:
    """The rows as they are; the job that reads them fails when a key repeats.  The check is part of the
    plan: each partition passes on at most two rows of a key before the shuffle."""
    pk = _cols(primary_key)
    n = F.row_number().over(Window.partitionBy(*pk).orderBy(F.lit(0)))
    once = F.when(F.col("__n") > 1, F.raise_error(F.lit(DUPLICATE_KEY)).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("__n", n).filter("__n <= 2").filter(once).drop("__n")


# --------------------------------------------------------------------------- U4
def incoming_is_newer(staged_cursor: Column, stored_cursor: Column) -> Column:
    """``s > t`` or (``t`` NULL and ``s`` not NULL); NULL counts as false."""
    newer = (staged_cursor > stored_cursor) | (stored_cursor.isNull() & staged_cursor.isNotNull())
    return F.coalesce(newer, F.lit(False))


def drop_stale(
    staged: DataFrame,
    target: DataFrame,
    primary_key: Sequence[str] | str,
    cursor: str,
) -> DataFrame:
    """Remove staged rows whose key is stored unless the incoming cursor is newer.
    Ties and a NULL incoming cursor lose: the stored row wins; a staged frame without
    the cursor column has NULL cursors.  Only the key and cursor columns of the target
    are read."""
    pk = _cols(primary_key)
    if cursor not in target.columns:  # nothing stored carries a cursor
        return staged
    if cursor not in staged.columns:
        return staged.join(target.select(*pk), pk, "left_anti")
    stored = target.select(
        *[F.col(k).alias(f"__t_{k}") for k in pk], F.col(cursor).alias("__t_cursor")
    )
    s = staged.alias("__s")
    cond = None
    for k in pk:
        c = F.col(f"__s.{k}") == F.col(f"__t_{k}")
        cond = c if cond is None else cond & c
    cond = cond & ~incoming_is_newer(F.col(f"__s.{cursor}"), F.col("__t_cursor"))
    return s.join(stored, cond, "left_anti").select(*[F.col(f"__s.{c}").alias(c) for c in staged.columns])


# --------------------------------------------------------------------------- U6
def deleted_flag(df: DataFrame, column: str) -> Column:
    """Tombstone test: a boolean flag deletes when TRUE; any other type deletes
    when NOT NULL.  FALSE and NULL are live rows."""
    if column not in df.columns:  # a file without the flag carries live rows only
        return F.lit(False)
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(F.col(column), F.lit(False))
    return F.col(column).isNotNull()


# --------------------------------------------------------------------------- U5
def upsert(
    target: DataFrame,
    staged: DataFrame,
    primary_key: Sequence[str] | str,
    *,
    partial: bool = False,
    deleted: str | None = None,
    source_filter: str | Column | None = None,
    skip_unchanged: bool = False,
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert ``staged`` into ``target`` on ``primary_key`` (plain ``=``: NULL keys
    never match).

    * ``partial``: only columns present in ``staged`` overwrite; stored values stay
      for the others (NULL for inserts).  Otherwise the staged row is the full record.
    * ``deleted``: staged rows flagged deleted remove the stored row and are not
      inserted (U6).
    * ``source_filter``: staged rows failing the predicate are ignored for insert,
      update and delete (P13).
    * ``skip_unchanged``: a matched row equal (null-safe) to the stored row on the
      ``compare`` columns keeps the stored row, including its load id (P14).

    Result = (target anti-joined with the passing staged keys) union (new rows).
    The target side of that anti join is streamed, never shuffled against the
    full staged record."""
    pk = _cols(primary_key)
    passing = staged
    if source_filter is not None:
        passing = passing.filter(F.expr(source_filter) if isinstance(source_filter, str) else source_filter)
    up = passing.filter(~deleted_flag(passing, deleted)) if deleted else passing
    out_cols = list(target.columns) + [c for c in staged.columns if c not in target.columns]

    kept = target.join(passing.select(*pk), pk, "left_anti")

    absent = [c for c in target.columns if c not in staged.columns]
    needs_stored = (partial and absent) or skip_unchanged
    if not needs_stored:
        new_rows = up.select(
            *[F.col(c) if c in staged.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
              for c in out_cols]
        )
    else:
        stored_cols = [c for c in target.columns if c not in pk]
        hit = target.select(*pk, *[F.col(c).alias(f"__t_{c}") for c in stored_cols], F.lit(True).alias("__hit"))
        joined = up.join(hit, pk, "left")
        matched = F.coalesce(F.col("__hit"), F.lit(False))

        def new_value(c: str) -> Column:
            if c in pk:
                return F.col(c)
            if c in staged.columns:
                return F.col(c)
            if partial and c in target.columns:
                return F.col(f"__t_{c}")
            return F.lit(None).cast(target.schema[c].dataType)

        if skip_unchanged:
            cmp = list(compare) if compare is not None else [
                c for c in out_cols if c not in pk and c not in LINEAGE and c != deleted
            ]
            cmp = [c for c in cmp if c in target.columns and (c in staged.columns or not partial)]
            changed = F.lit(False)
            for c in cmp:
                changed = changed | ~new_value(c).eqNullSafe(F.col(f"__t_{c}"))
            keep_stored = matched & ~changed
            sel = []
            for c in out_cols:
                if c in pk or c not in target.columns:
                    sel.append(new_value(c).alias(c))
                else:
                    sel.append(F.when(keep_stored, F.col(f"__t_{c}")).otherwise(new_value(c)).alias(c))
        else:
            sel = [new_value(c).alias(c) for c in out_cols]
        new_rows = joined.select(*sel)

    kept = kept.select(
        *[F.col(c) if c in target.columns else F.lit(None).cast(staged.schema[c].dataType).alias(c)
          for c in out_cols]
    )
    return kept.unionByName(new_rows)


def fold_groups(groups: Sequence[DataFrame], target: DataFrame, primary_key: Sequence[str] | str,
                schema: T.StructType, cursor: str | None = None) -> DataFrame:
    """Partial-column groups applied one after another, folded into one row per key.

    Column ``c`` of the result is a struct holding the last applied value, or NULL where
    no applied row carried ``c``.  A row is applied if its key is new or its cursor is
    newer than the stored one and all earlier ones.  The target is read once (key and
    cursor), however many groups there are."""
    pk = _cols(primary_key)
    columns = [f for f in schema.fields if f.name not in pk and any(f.name in g.columns for g in groups)]
    rows = union_staged([
        g.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in pk], F.lit(i).alias("__g"),
                 (F.col(cursor).cast(schema[cursor].dataType) if cursor and cursor in g.columns
                  else F.lit(None).cast(schema[cursor].dataType if cursor and cursor in schema.fieldNames() else "int")).alias("__c"),
                 *[(F.struct(F.col(f"`{f.name}`").cast(f.dataType).alias("v")) if f.name in g.columns
                    else F.lit(None).cast(T.StructType([T.StructField("v", f.dataType)]))).alias(f.name) for f in columns])
        for i, g in enumerate(groups)])
    if cursor and cursor in schema.fieldNames():
        stored = target.select(*pk, F.col(cursor).alias("__t"), F.lit(True).alias("__stored"))
        order = Window.partitionBy(*pk).orderBy("__g")
        before = F.max("__c").over(order.rowsBetween(Window.unboundedPreceding, -1))
        fresh = F.col("__stored").isNull() & (F.row_number().over(order) == 1)
        rows = rows.join(stored, pk, "left").withColumn(
            "__use", fresh | incoming_is_newer(F.col("__c"), F.greatest(before, F.col("__t")))).filter("__use")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__g")))
    return rows.groupBy(*pk).agg(*[last(f.name).alias(f.name) for f in columns])


def upsert_folded(target: DataFrame, folded: DataFrame, primary_key: Sequence[str] | str) -> DataFrame:
    """Target rows without a folded key, and the folded rows over their stored values."""
    pk = _cols(primary_key)
    kept = target.join(folded.select(*pk), pk, "left_anti").select(*target.columns)
    stored = target.select(*pk, *[F.col(f"`{c}`").alias(f"__t_{c}") for c in target.columns if c not in pk])
    joined = folded.join(stored, pk, "left")
    value = lambda c: (F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`")["v"]).otherwise(F.col(f"`__t_{c}`"))
                       if c in folded.columns else F.col(f"`__t_{c}`"))
    return kept.unionByName(joined.select(*[F.col(f"`{c}`") if c in pk else value(c).alias(c) for c in target.columns]))


# --------------------------------------------------------------------------- U8
def drop_orphans(children: DataFrame, roots: DataFrame | None, root_key: str = ROOT_ID,
                 root_row_key: str = ROW_ID) -> DataFrame:
    """Staged child rows whose root is not among the surviving staged roots are
    discarded.  A semi join, not ``NOT IN`` (whose NULL semantics would empty it).  ``roots`` is None
    where every staged root survives: a child comes with its root, so none is an orphan."""
    if roots is None:
        return children
    keys = roots.select(F.col(root_row_key).alias(root_key))
    return children.join(keys, root_key, "left_semi").select(*children.columns)


# --------------------------------------------------------------------------- U9
def replace_children(
    stored_children: DataFrame,
    staged_children: DataFrame,
    passing_roots: DataFrame,
    upserted_roots: DataFrame | None,
    root_key: str = ROOT_ID,
    root_row_key: str = ROW_ID,
) -> DataFrame:
    """Children of every passing staged root are replaced by the staged set: stored
    children of those roots go, staged children of upserted roots come in, and
    other roots' children stay untouched.  Deleted roots lose their children.  ``upserted_roots`` is
    None where every staged root is upserted, as in ``drop_orphans``."""
    gone = passing_roots.select(F.col(root_row_key).alias(root_key))
    keep = stored_children.join(gone, root_key, "left_anti")
    come = drop_orphans(staged_children, upserted_roots, root_key, root_row_key)
    out_cols = list(stored_children.columns) + [c for c in staged_children.columns if c not in stored_children.columns]
    keep = keep.select(*[F.col(c) if c in stored_children.columns else
                         F.lit(None).cast(staged_children.schema[c].dataType).alias(c) for c in out_cols])
    come = come.select(*[F.col(c) if c in staged_children.columns else
                         F.lit(None).cast(stored_children.schema[c].dataType).alias(c) for c in out_cols])
    return keep.unionByName(come)


# --------------------------------------------------------------------------- U7
def surviving_roots(live: DataFrame, root) -> tuple[DataFrame, DataFrame]:
    """Of the staged roots that are not stale: those that pass the source filter, and of
    these the ones that are not tombstones."""
    passing = live.filter(F.expr(root.source_filter)) if root.source_filter else live
    flag = root.hard_delete_column
    return passing, passing.filter(~deleted_flag(passing, flag)) if flag else passing


def merge_root(stored: DataFrame, live: DataFrame, root) -> DataFrame:
    """New content of a root table on the staged route: full records, filter, tombstones."""
    return upsert(stored, live, list(root.primary_key), deleted=root.hard_delete_column,
                  source_filter=root.source_filter, skip_unchanged=root.skip_unchanged)


def keeps_all_roots(root) -> bool:
    """Whether no staged root of a chain can be stale, filtered out or deleted (its keys are unique)."""
    return not (root.cursor or root.source_filter or root.hard_delete_column)


def merge_child(stored: DataFrame, staged: DataFrame, live: DataFrame | None, passing: DataFrame, up: DataFrame | None) -> DataFrame:
    """New content of a child table: orphans go, children of passing roots are replaced.  ``live`` and ``up``
    are None where all staged roots stay (``keeps_all_roots``): the staged children then cross no join."""
    return replace_children(stored, drop_orphans(staged, live), passing, up)


def merge_chain(
    stored: dict[str, DataFrame],
    staged: dict[str, DataFrame],
    chain: Sequence,
) -> dict[str, DataFrame]:
    """Merge a root table and its child tables: the steps ``plans.load`` takes, without
    the storage between them.  ``chain`` is a list of ``TableContract`` (root first).
    Returns the new content of every table.  The uniqueness guard of a chain needs an
    action and is not evaluated here."""
    root = chain[0]
    pk = list(root.primary_key)
    s_root = staged[root.name]
    if len(chain) == 1:
        s_root = dedup_latest(s_root, pk, root.cursor, root.tie_break)
    live = drop_stale(s_root, stored[root.name], pk, root.cursor) if root.cursor else s_root
    passing, up = surviving_roots(live, root)
    out = {root.name: merge_root(stored[root.name], live, root)}
    for child in chain[1:]:
        out[child.name] = merge_child(stored[child.name], staged[child.name], live, passing, up)
    return out
