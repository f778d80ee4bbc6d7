"""Partition layouts (L1-L8, L10) as derived directory columns.

Spark's file tables partition by plain columns only (``years(ts)`` is rejected),
so every transform becomes a derived column ``_p_<col>_<transform>`` written with
``partitionBy``.  Identity keys write the directory code of the value, which is never
empty or NULL (Spark reads both from one folder name) and keeps the order of the values;
the column itself stays in the files, so every value reads back as it was.  Readers
prune through the derived columns: ``prune`` turns a range on the source column into
a condition on them, which Spark pushes down as a partition filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.functions.keycode import directory_code, key_code
from tableload.functions.partition import PartitionKey, parse_layout

# The calendar transforms from coarse to fine.
CALENDAR = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}


def key_expr(key: PartitionKey, dtype: T.DataType) -> Column:
    """Value of a key's derived column for a source column of type ``dtype``."""
    c = F.col(f"`{key.column}`")
    if key.transform == "identity":
        return directory_code(c, dtype)
    if key.transform == "bucket":
        # hash of the code: 7 lands in one bucket as INT, BIGINT or DECIMAL(20,0)
        return F.pmod(F.hash(key_code([c], [dtype])), F.lit(key.buckets))
    return CALENDAR[key.transform](c)


def derived_type(key: PartitionKey) -> T.DataType:
    return T.StringType() if key.transform == "identity" else T.IntegerType()


def layout_columns(df: DataFrame, keys: Sequence[PartitionKey] | None) -> tuple[DataFrame, list[str]]:
    """Add the derived partition columns; return the frame and the ``partitionBy``
    column list (in key order)."""
    if not keys:
        return df, []
    keys = parse_layout(list(keys))
    names: list[str] = []
    for key in keys:
        name = key.derived_name
        dtype = df.schema[key.column].dataType if key.column in df.columns else T.NullType()
        df = df.withColumn(name, key_expr(key, dtype) if key.column in df.columns else F.lit("n" if key.transform == "identity" else None)
                           .cast(derived_type(key)))
        if name not in names:
            names.append(name)
    return df, names


def drop_layout_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_p_")])


def _from(names: Sequence[Column], bounds: Sequence[Column], above: bool) -> Column:
    """``names >= bounds`` (or ``<=``) compared part by part, coarse first."""
    out = None
    for name, bound in zip(reversed(names), reversed(bounds), strict=True):
        beyond = name > bound if above else name < bound
        out = (beyond | (name == bound)) if out is None else beyond | ((name == bound) & out)
    return out


def prune(keys: Sequence[PartitionKey], column: str, dtype: T.DataType, lo=None, hi=None) -> Column:
    """Predicate on the derived columns implied by ``lo <= column <= hi``.  AND it
    with the range on the column itself; it only adds partition filters.

    Calendar keys that start at the year are covered exactly: the folders (year, month, ...)
    are compared part by part, so 31 January to 2 February reads three days.  A finer
    part without its coarser ones wraps around and counts only while those agree in both
    bounds.  Identity folders are compared by the code of the bounds.  The bounds are cast to
    the column's type and taken apart by Spark (constant folding), so they follow the
    session time zone as the written rows did."""
    low, high = (F.lit(v).cast(dtype) if v is not None else None for v in (lo, hi))
    coarse_first = list(CALENDAR)
    mine = {k.transform: F.col(f"`{k.derived_name}`") for k in keys if k.column == column and k.transform in CALENDAR}
    pred = F.lit(True)
    chain = []
    for part in coarse_first:
        if part not in mine:
            break
        chain.append(part)
    if chain:
        names = [mine[p] for p in chain]
        pred = names[0].isNotNull()  # rows without a value are in no range
        for bound, above in ((low, True), (high, False)):
            if bound is not None:
                pred = pred & _from(names, [CALENDAR[p](bound) for p in chain], above)
    for part in coarse_first[len(chain):]:
        if part in mine and low is not None and high is not None:
            same = F.lit(True)
            for coarser in coarse_first[:coarse_first.index(part)]:
                same = same & (CALENDAR[coarser](low) == CALENDAR[coarser](high))
            pred = pred & (~same | mine[part].between(CALENDAR[part](low), CALENDAR[part](high)))
    for key in keys:
        if key.column != column or key.transform != "identity":
            continue
        name = F.col(f"`{key.derived_name}`")
        of = (lambda c: directory_code(c, dtype)) if key.coded else (lambda c: c)
        if low is not None:
            pred = pred & (name >= of(low))
        if high is not None:
            pred = pred & (name <= of(high))
    return pred
