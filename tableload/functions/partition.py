"""Partition layout hints.

A layout is an ordered list of ``PartitionKey``s.  A key checks itself when it is
made, so every way of writing one down (a column name, a spec dict, the helper
functions) obeys the same rules.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, fields
from typing import Any

from tableload.errors import ContractError

# The supported transforms and the bucket-count bound.
TRANSFORMS = ("identity", "year", "month", "day", "hour", "bucket")
TIME_TRANSFORMS = ("year", "month", "day", "hour")
MAX_SIGNED_INT32 = 2**31 - 1


@dataclass(frozen=True)
class PartitionKey:
    column: str
    transform: str = "identity"
    buckets: int | None = None
    # False for folders written before values were coded: identity folders of the column itself, buckets of its text
    coded: bool = field(default=True, compare=False, repr=False)

    def __post_init__(self) -> None:
        wrong = None
        if not (isinstance(self.column, str) and self.column.replace("\x00", "") == self.column != ""):
            wrong = "needs the name of a column"
        elif self.transform not in TRANSFORMS:
            wrong = f"knows only the transforms {', '.join(TRANSFORMS)}"
        elif self.transform != "bucket" and self.buckets is not None:
            wrong = "takes a bucket count with the bucket transform only"
        elif self.transform == "bucket" and not _is_bucket_count(self.buckets):
            wrong = f"needs between 1 and {MAX_SIGNED_INT32} buckets"
        if wrong:
            raise ContractError(f"a partition key {wrong}; got {self!r}")

    @classmethod
    def of(cls, spec: Any) -> PartitionKey:
        """The key that a name, a spec dict or a key stands for."""
        if isinstance(spec, cls):
            return spec
        names = [f.name for f in fields(cls) if f.compare]
        if isinstance(spec, dict) and spec.keys() <= set(names):
            return cls(**{"column": "", **spec})
        if isinstance(spec, str):
            return cls(spec)
        raise ContractError(f"a partition key is a column name, a dict of {names} or a key; got {spec!r}")

    @property
    def derived_name(self) -> str:
        """Name of the directory column the key writes; the column itself stays in the files."""
        if self.transform == "identity" and not self.coded:
            return self.column
        suffix = {"identity": "value", "bucket": f"bucket{self.buckets}"}.get(self.transform, self.transform)
        return f"_p_{self.column}_{suffix}"


def _is_bucket_count(n: Any) -> bool:
    return isinstance(n, int) and not isinstance(n, bool) and 1 <= n <= MAX_SIGNED_INT32


def identity(column: str) -> PartitionKey:
    return PartitionKey(column)


def year(column: str) -> PartitionKey:
    return PartitionKey(column, "year")


def month(column: str) -> PartitionKey:
    return PartitionKey(column, "month")


def day(column: str) -> PartitionKey:
    return PartitionKey(column, "day")


def hour(column: str) -> PartitionKey:
    return PartitionKey(column, "hour")


def bucket(buckets: int, column: str) -> PartitionKey:
    return PartitionKey(column, "bucket", buckets)


def parse_layout(hint: Any) -> list[PartitionKey]:
    """The keys of a layout hint: one key or several, none twice.  ``[]`` means
    "unpartitioned"."""
    one = isinstance(hint, (str, dict, PartitionKey))
    if not one and not (isinstance(hint, Iterable) and not isinstance(hint, (bytes, set))):
        raise ContractError(f"a layout is one partition key or a sequence of them; got {hint!r}")
    layout = [PartitionKey.of(spec) for spec in ([hint] if one else hint)]
    twice = {k for k in layout if layout.count(k) > 1}
    if twice:
        raise ContractError(f"a layout names each key once; repeated: {sorted(map(repr, twice))}")
    return layout
