"""Deterministic lineage ids.

Ids are the 128-bit MD5 digest (32 hex characters) of a canonical text, so a task
retry, a re-run of the same load or a reload of identical rows all produce the same
ids.  MD5 serves as a fast, well-spread 128-bit hash here, not as a security
primitive; at 10^12 rows the collision odds stay below 10^-14.  No
``uuid()`` / ``monotonically_increasing_id()``: their values change on retry
and would break parent links.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.functions.keycode import key_code

# Lineage column names and id width.
LOAD_ID = "_load_id"
ROW_ID = "_row_id"
PARENT_ID = "_parent_id"
ROOT_ID = "_root_id"
LIST_IDX = "_list_idx"
VALUE = "value"
LINEAGE = (LOAD_ID, ROW_ID, PARENT_ID, ROOT_ID, LIST_IDX)
ID_HEX_CHARS = 32
SEP = "|"


def key_id(columns: Sequence[str | Column], types: Sequence[T.DataType] | None = None) -> Column:
    """Row id of a keyed root: digest of the code of its key values, so that different keys never share an
    id.  ``types`` are those of the columns; values without one are taken as text."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if types is None:
        cols, types = [c.cast("string") for c in cols], [T.StringType()] * len(cols)
    return F.md5(key_code(cols, types))


def child_id(parent_id: str | Column, path: str, idx: str | Column) -> Column:
    """Row id of a child element: digest of parent id, table path and list index."""
    p = F.col(parent_id) if isinstance(parent_id, str) else parent_id
    i = F.col(idx) if isinstance(idx, str) else idx
    return F.md5(F.concat_ws(SEP, p, F.lit(path), i.cast("string")))
