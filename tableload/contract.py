"""Table contracts and whole-load validation.

A ``TableContract`` is the declared shape and hints of one table.  ``validate``
checks every contract of a load before any Spark action runs, so one bad table
stops the whole load with nothing written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import types as T

from tableload.errors import ContractError
from tableload.functions.naming import check_collisions
from tableload.functions.partition import TIME_TRANSFORMS, PartitionKey, parse_layout
from tableload.functions.types import field_metadata, logical_type

DISPOSITIONS = ("append", "replace", "merge")
# Merge strategies the reference names and refuses.
REFUSED_STRATEGIES = ("delete-insert", "insert-only", "scd2", "cdc")


@dataclass(frozen=True)
class TableContract:
    name: str
    disposition: str = "append"
    primary_key: tuple[str, ...] = ()
    cursor: str | None = None
    cursor_order: str = "desc"
    tie_break: tuple[str, ...] = ()
    hard_delete: str | tuple[str, ...] | None = None
    merge_key: tuple[str, ...] = ()
    strategy: str = "upsert"
    parent: str | None = None
    partition: Any = None  # None: keep the stored layout, []: reset, list: new layout
    sort: tuple[str, ...] = ()
    source_filter: str | None = None
    skip_unchanged: bool = False
    description: str | None = None
    columns: dict[str, dict[str, Any]] = field(default_factory=dict)
    schema: T.StructType | None = None

    def with_partition(self, *keys: Any) -> "TableContract":
        if self.sort:
            raise ContractError("sort hints are unsupported")
        flat: list[Any] = []
        for k in keys:
            flat.extend(k if isinstance(k, (list, tuple)) else [k])
        return replace(self, partition=parse_layout(flat))

    def declared_schema(self) -> T.StructType | None:
        """Schema from the column specs (order of the spec dict), or ``schema``."""
        if self.schema is not None:
            return self.schema
        if not self.columns or not all("data_type" in c for c in self.columns.values()):
            return None
        return T.StructType([
            T.StructField(n, logical_type(c), c.get("nullable", n not in self.primary_key),
                          field_metadata(c))
            for n, c in self.columns.items()
        ])

    @property
    def layout(self) -> list[PartitionKey] | None:
        if self.partition is None:
            return None
        return parse_layout(self.partition)

    @property
    def hard_delete_column(self) -> str | None:
        if isinstance(self.hard_delete, tuple):
            return self.hard_delete[0] if self.hard_delete else None
        return self.hard_delete


def is_staged_route(root: TableContract, chain_length: int) -> bool:
    """The staged chain merge is used when the root has a hard-delete flag or the
    chain has child tables; otherwise a flat merge applies partial columns."""
    return root.disposition == "merge" and (bool(root.hard_delete) or chain_length > 1)


def _column_names(c: TableContract) -> list[str]:
    names = list(c.columns)
    if c.schema is not None:
        names += [f.name for f in c.schema.fields if f.name not in c.columns]
    return names


def _column_type(c: TableContract, name: str) -> T.DataType | None:
    if name in c.columns and "data_type" in c.columns[name]:
        return logical_type(c.columns[name])
    if c.schema is not None and name in c.schema.fieldNames():
        return c.schema[name].dataType
    return None


def validate_one(c: TableContract, contracts: Sequence[TableContract]) -> None:
    if c.disposition not in DISPOSITIONS:
        raise ContractError(f"{c.name}: unknown write disposition {c.disposition!r}")
    names = _column_names(c)
    check_collisions(names, f"{c.name}: ")
    for spec in c.columns.values():
        if "data_type" in spec:
            logical_type(spec)
    if c.sort or any("sort" in spec for spec in c.columns.values()):
        raise ContractError(f"{c.name}: sort hints are unsupported")
    has_children = any(o.parent == c.name for o in contracts)
    hard = c.hard_delete if isinstance(c.hard_delete, tuple) else ((c.hard_delete,) if c.hard_delete else ())
    if c.disposition == "merge" and c.parent is None:
        if c.strategy in REFUSED_STRATEGIES or c.strategy != "upsert":
            raise ContractError(f"{c.name}: merge strategy {c.strategy!r} is unsupported; use upsert")
        if c.merge_key:
            raise ContractError(f"{c.name}: merge keys are unsupported; declare a primary key")
        if not c.primary_key:
            raise ContractError(f"{c.name}: an upsert needs a primary key")
        if c.cursor and c.cursor_order != "desc":
            raise ContractError(f"{c.name}: only a descending dedup sort is supported")
        if len(hard) > 1:
            raise ContractError(f"{c.name}: at most one hard_delete column")
        for k in c.primary_key:
            if c.columns.get(k, {}).get("nullable") is True:
                raise ContractError(f"{c.name}: primary key column {k!r} must not be nullable")
        if (c.source_filter or c.skip_unchanged) and not (has_children or hard):
            raise ContractError(
                f"{c.name}: source_filter and skip_unchanged need the staged merge "
                "(a child table or a hard_delete column)"
            )
    if c.partition is not None:
        _check_layout(c, parse_layout(c.partition), names)


def _check_layout(c: TableContract, keys: list[PartitionKey], names: list[str]) -> None:
    """A layout needs a table that outlives the load, columns that are there, and times
    for the parts of times."""
    if c.disposition == "replace" and keys:
        raise ContractError(f"{c.name}: a replaced table starts anew with each load and keeps no layout")
    unknown = sorted({k.column for k in keys} - set(names)) if names else []
    if unknown:
        raise ContractError(f"{c.name}: the layout names columns the table lacks: {unknown}")
    for key in keys:
        dt = _column_type(c, key.column)
        if dt is None or key.transform not in TIME_TRANSFORMS:
            continue
        fit = (T.TimestampType, T.TimestampNTZType) + (() if key.transform == "hour" else (T.DateType,))
        if not isinstance(dt, fit):
            raise ContractError(f"{c.name}: {dt.simpleString()} column {key.column!r} has no {key.transform}")


def validate(contracts: Sequence[TableContract], allow_destructive: Any = None,
             refresh: str | None = None) -> None:
    """Check every contract of a load before writing anything."""
    if refresh in ("drop_data", "drop_resources") and allow_destructive is not True:
        from tableload.errors import DestructiveRefreshRefused
        raise DestructiveRefreshRefused(f"refresh={refresh!r} needs allow_destructive=True")
    if refresh not in (None, "drop_data", "drop_resources"):
        raise ContractError(f"unknown refresh mode {refresh!r}")
    check_collisions([c.name for c in contracts], "tables: ")
    for c in contracts:
        validate_one(c, contracts)


def chains(contracts: Sequence[TableContract]) -> list[list[TableContract]]:
    """Group contracts into root-first chains (parents before children)."""
    by_parent: dict[str | None, list[TableContract]] = {}
    for c in contracts:
        by_parent.setdefault(c.parent, []).append(c)
    out = []
    for root in by_parent.get(None, []):
        chain, todo = [], [root]
        while todo:
            t = todo.pop(0)
            chain.append(t)
            todo.extend(by_parent.get(t.name, []))
        out.append(chain)
    return out
