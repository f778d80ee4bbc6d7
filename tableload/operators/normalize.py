"""Nested records -> parent/child table chains.

``normalize`` walks the schema once on the driver and emits one DataFrame plan
per table; no data passes through the driver.  Structs flatten into
``parent__child`` columns, lists become child tables exploded with
``posexplode`` (an empty list yields no child rows), and anything deeper than
``max_nesting`` is kept as JSON text.  Each nesting step -- into a struct or a
list -- counts one level, so ``max_nesting=0`` stores every nested value as JSON.

Lineage is deterministic: a keyed root's ``_row_id`` is a digest of its key, a
child's ``_row_id`` a digest of (parent id, table path, list index), so retried
tasks and reloads of the same rows reproduce the same ids.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.functions.lineage import (
    LINEAGE, LIST_IDX, LOAD_ID, PARENT_ID, ROOT_ID, ROW_ID, VALUE, child_id, key_id,
)
from tableload.errors import ContractError
from tableload.functions.naming import check_collisions, normalize_name

SEP = "__"
_JSON_OPTS = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class NormalizedTable:
    name: str
    parent: str | None
    frame: DataFrame
    path: tuple[str, ...]  # field path from the root record


def _nested(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StructType, T.ArrayType, T.MapType))


def as_json(col: Column, dt: T.DataType) -> Column:
    """JSON text of a nested value, NULL fields kept (Spark drops them by default)."""
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col, _JSON_OPTS)
    return col


def nested_as_json(df: DataFrame) -> DataFrame:
    """Every struct / list / map column becomes a JSON string column."""
    return df.select(*[
        as_json(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if _nested(f.dataType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def align_to_schema(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """Columns in the contract's order, missing ones as typed NULLs, types cast
    to the contract (ANSI casts raise rather than lose data).  A frame that is
    already aligned passes through unchanged (Catalyst drops the no-op project)."""
    present = {c: c for c in df.columns}
    lower = {c.casefold(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name) or lower.get(f.name.casefold())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            cols.append(F.col(f"`{src}`").alias(f.name))
        else:
            cols.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    if keep_extra:
        known = {f.name.casefold() for f in schema.fields}
        cols += [F.col(f"`{c}`") for c in df.columns if c.casefold() not in known]
    if [f.name for f in schema.fields] == df.columns and all(
        df.schema[f.name].dataType == f.dataType for f in schema.fields
    ):
        return df
    return df.select(*cols)


def _flatten(
    col: Column, dt: T.DataType, name: str, level: int, max_nesting: int | None,
    naming: str,
) -> tuple[list[tuple[str, Column]], list[tuple[str, Column, T.ArrayType, int]]]:
    """Columns ``(name, expr)`` of one table for the value ``col`` named ``name`` at
    ``level``, and the lists found that become child tables (name, expr, type, level)."""
    deep = max_nesting is not None and level >= max_nesting
    if isinstance(dt, T.StructType) and not deep:
        cols, lists = [], []
        for f in dt.fields:
            sub = f"{name}{SEP}{normalize_name(f.name, naming)}"
            c, l2 = _flatten(col.getField(f.name), f.dataType, sub, level + 1, max_nesting, naming)
            cols += c
            lists += l2
        return cols, lists
    if isinstance(dt, T.ArrayType) and not deep:
        return [], [(name, col, dt, level)]
    if _nested(dt):
        return [(name, as_json(col, dt))], []
    return [(name, col)], []


def _flatten_record(
    fields: list[tuple[str, Column, T.DataType]], level: int, max_nesting: int | None, naming: str,
) -> tuple[list[tuple[str, Column]], list[tuple[str, Column, T.ArrayType, int]]]:
    """Top-level fields of one table's record, each at ``level``."""
    cols, lists = [], []
    for fname, col, dt in fields:
        c, l2 = _flatten(col, dt, normalize_name(fname, naming), level, max_nesting, naming)
        cols += c
        lists += l2
    return cols, lists


def _check_reserved(names: Sequence[str], table: str) -> None:
    """Lineage columns are the library's own; an input must not bring them."""
    taken = sorted(n for n in names if n.casefold() in LINEAGE)
    if taken:
        raise ContractError(f"{table}: columns {taken} are written by the load; rename or drop them in the input")


def normalize(
    df: DataFrame,
    table: str,
    *,
    primary_key: Sequence[str] = (),
    max_nesting: int | None = 0,
    naming: str = "direct",
    load_id: str | Column | None = None,
    row_id: Column | None = None,
    extra: dict[str, Column] | None = None,
    hidden: Sequence[str] = (),
    types: dict[str, T.DataType] | None = None,
) -> list[NormalizedTable]:
    """Split nested records into a root table and child tables, root first.

    ``primary_key`` (in normalized names) gives the root's ``_row_id``; without one
    pass ``row_id`` (e.g. a digest of file name and row index of a staged file),
    else the digest of the whole normalized row is used.  ``extra`` columns are
    computed on the input and appended to the root table as named; ``hidden`` input
    columns are there for ``row_id`` and ``extra`` only.  ``types`` gives root columns (in
    normalized names) the type their table stores, before ids are made of them."""
    table = normalize_name(table, naming)
    base, names, lists = _root_rows(df, table, primary_key, max_nesting, naming, load_id, row_id, extra or {}, hidden, types or {})
    tail = [*([LOAD_ID] if load_id is not None else []), ROW_ID, *(extra or {})]
    out = [NormalizedTable(table, None, base.select(*names, *tail), ())]
    for i, (lname, _, ldt, level) in enumerate(lists):
        out += _children(base, f"__list{i}", ldt, f"{table}{SEP}{lname}", table, level, max_nesting,
                         naming, ROW_ID, (lname,))
    return out


def _root_rows(df: DataFrame, table: str, primary_key: Sequence[str], max_nesting: int | None, naming: str, load_id, row_id,
               extra: dict[str, Column], hidden: Sequence[str], types: dict[str, T.DataType]) -> tuple:
    """The root's rows with their lists as ``__list<i>``, the names of its own columns, and the lists."""
    root_cols, lists = _flatten_record(
        [(f.name, F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if f.name not in hidden],
        0, max_nesting, naming)
    names = [n for n, _ in root_cols]
    check_collisions(names, f"{table}: ")
    _check_reserved(names, table)
    root_cols = [(n, c.cast(types[n]) if n in types else c) for n, c in root_cols]
    pk = list(primary_key)
    if row_id is not None:
        rid = row_id
    elif pk:
        rid = None  # computed after projection, from normalized key names
    else:
        rid = key_id([F.md5(F.to_json(F.struct(*[c.alias(n) for n, c in root_cols]), _JSON_OPTS))])
    base = df.select(
        *[c.alias(n) for n, c in root_cols],
        *[c.alias(f"__list{i}") for i, (_, c, _, _) in enumerate(lists)],
        *([rid.alias(ROW_ID)] if rid is not None else []),
        *[c.alias(n) for n, c in extra.items()],
    )
    if rid is None:
        base = base.withColumn(ROW_ID, key_id([F.col(f"`{k}`") for k in pk], [base.schema[k].dataType for k in pk]))
    if load_id is not None:
        base = base.withColumn(LOAD_ID, load_id if isinstance(load_id, Column) else F.lit(load_id))
    return base, names, lists


TAG = "__t"


def one_pass(df: DataFrame, table: str, *, load_id=None, extra: dict[str, Column] | None = None, naming: str = "direct",
             max_nesting: int | None = 0, **options) -> tuple[DataFrame, list[NormalizedTable]]:
    """All tables of the chain as one relation over one reading of ``df``: ``__t`` is the table's place in
    the chain and the column ``t<place>`` holds its row (without columns of NULLs only, which have no stored
    form).  Takes the arguments of ``normalize`` and returns its tables as well (their
    plans read ``df`` again; here they give names and schemas)."""
    tables = normalize(df, table, load_id=load_id, extra=extra, naming=naming, max_nesting=max_nesting, **options)
    place = {t.name: i for i, t in enumerate(tables)}
    schemas = [T.StructType([f for f in t.frame.schema.fields if not isinstance(f.dataType, T.NullType)]) for t in tables]
    table = tables[0].name
    base, _, lists = _root_rows(df, table, options.get("primary_key", ()), max_nesting, naming, load_id, options.get("row_id"),
                                extra or {}, options.get("hidden", ()), options.get("types") or {})

    def tagged(name: str, row: Column) -> Column:
        mine = place[name]
        return F.struct(F.lit(mine).alias(TAG), *[
            (row.cast(schemas[i]) if i == mine else F.lit(None).cast(schemas[i])).alias(f"t{i}") for i in range(len(tables))])

    def rows_of(values: Column, dt: T.ArrayType, name: str, level: int, parent: Column, root: Column) -> Column:
        """The tagged rows of a list and of the lists in its elements."""
        def flat(elem: Column):
            if isinstance(dt.elementType, T.StructType):
                return _flatten_record([(f.name, elem.getField(f.name), f.dataType) for f in dt.elementType.fields],
                                       level + 1, max_nesting, naming)
            return _flatten(elem, dt.elementType, VALUE, level + 1, max_nesting, naming)

        def rows(elem: Column, idx: Column, own_id: Column) -> tuple[Column, list[Column]]:
            cols, inner = flat(elem)
            own = F.struct(*[c.alias(n) for n, c in cols if n in schemas[place[name]].names], own_id.alias(ROW_ID), parent.alias(PARENT_ID), root.alias(ROOT_ID),
                           idx.alias(LIST_IDX))
            below = [rows_of(c, ldt, f"{name}{SEP}{lname}", lvl, own_id, root) for lname, c, ldt, lvl in inner]
            return tagged(name, own), below

        if not flat(F.lit(None).cast(dt.elementType))[1]:
            every = F.transform(values, lambda elem, idx: rows(elem, idx, child_id(parent, name, idx))[0])
        else:
            def with_inner(elem: Column, idx: Column) -> Column:
                # the element's id is made once and shared by its children
                def body(own_id: Column) -> Column:
                    own, below = rows(elem, idx, own_id)
                    return F.concat(F.array(own), *below)
                return F.flatten(F.transform(F.array(child_id(parent, name, idx)), body))
            every = F.flatten(F.transform(values, with_inner))
        return F.coalesce(every, F.array())

    root_row = F.struct(*[F.col(f"`{c}`").alias(c) for c in schemas[0].fieldNames()])
    parts = [F.array(tagged(table, root_row))]
    parts += [rows_of(F.col(f"__list{i}"), ldt, f"{table}{SEP}{lname}", level, F.col(ROW_ID), F.col(ROW_ID))
              for i, (lname, _, ldt, level) in enumerate(lists)]
    return base.select(F.explode(F.concat(*parts)).alias("r")).select("r.*"), tables


def _children(
    parent: DataFrame, list_col: str, dt: T.ArrayType, name: str, parent_name: str, level: int,
    max_nesting: int | None, naming: str, root_col: str, path: tuple[str, ...],
) -> list[NormalizedTable]:
    """Explode one list column of ``parent`` into the child table ``name``."""
    root_expr = F.col(ROW_ID) if root_col == ROW_ID else F.col(ROOT_ID)
    exploded = parent.select(
        F.col(ROW_ID).alias(PARENT_ID), root_expr.alias(ROOT_ID),
        F.posexplode(F.col(list_col)).alias(LIST_IDX, "__elem"),
    )
    elem_dt = dt.elementType
    elem = F.col("__elem")
    if isinstance(elem_dt, T.StructType):
        cols, lists = _flatten_record(
            [(f.name, elem.getField(f.name), f.dataType) for f in elem_dt.fields], level + 1, max_nesting, naming)
    else:
        cols, lists = _flatten(elem, elem_dt, VALUE, level + 1, max_nesting, naming)
    names = [n for n, _ in cols]
    check_collisions(names, f"{name}: ")
    _check_reserved(names, name)
    table = exploded.select(
        *[c.alias(n) for n, c in cols],
        *[c.alias(f"__list{i}") for i, (_, c, _, _) in enumerate(lists)],
        F.col(PARENT_ID), F.col(ROOT_ID), F.col(LIST_IDX),
        child_id(F.col(PARENT_ID), name, F.col(LIST_IDX)).alias(ROW_ID),
    )
    out = [NormalizedTable(name, parent_name, table.select(*names, ROW_ID, PARENT_ID, ROOT_ID, LIST_IDX), path)]
    for i, (lname, _, ldt, lvl) in enumerate(lists):
        out += _children(table, f"__list{i}", ldt, f"{name}{SEP}{lname}", name, lvl, max_nesting, naming,
                         ROOT_ID, path + (lname,))
    return out
