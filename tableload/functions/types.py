"""Logical column types -> Spark types (contract check E1, P10-P12)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

from tableload.errors import ContractError

# The default precision/scale of an unparameterised decimal and the
# widest decimal a table accepts.
DEFAULT_DECIMAL = (38, 9)
MAX_DECIMAL_PRECISION = 38
# Fixed value: a 64-bit unsigned integer needs 20 decimal digits.
UINT64_DECIMAL = T.DecimalType(20, 0)

# Metadata key marking a LongType column that carries epoch nanoseconds.
NS_TIMESTAMP = "timestamp_ns"


def logical_type(spec: dict[str, Any] | str) -> T.DataType:
    """Map a column spec (``{"data_type": "decimal", "precision": 12, "scale": 3}``)
    to the Spark type the table stores.  Raises ``ContractError`` for types that
    cannot be stored without loss (256-bit integers, out-of-range decimals)."""
    if isinstance(spec, str):
        spec = {"data_type": spec}
    kind = spec.get("data_type")
    precision = spec.get("precision")
    if kind == "text":
        return T.StringType()
    if kind == "bigint":
        if spec.get("unsigned") and (precision is None or precision > 63):
            return UINT64_DECIMAL
        return T.LongType()
    if kind == "double":
        return T.DoubleType()
    if kind == "bool":
        return T.BooleanType()
    if kind == "timestamp":
        if spec.get("timezone", True) is False:
            if precision is not None and precision > 6:
                return T.LongType()
            return T.TimestampNTZType()
        return T.TimestampType()
    if kind == "date":
        return T.DateType()
    if kind == "time":
        return T.StringType() if not _time_supported() else _time_type()
    if kind == "json":
        return T.StringType()
    if kind == "binary":
        return T.BinaryType()
    if kind == "decimal":
        if precision is None:
            return T.DecimalType(*DEFAULT_DECIMAL)
        scale = spec.get("scale") or 0
        if not (1 <= precision <= MAX_DECIMAL_PRECISION and 0 <= scale <= precision):
            raise ContractError(
                f"decimal({precision},{scale}) is outside 1 <= precision <= 38, 0 <= scale <= precision"
            )
        return T.DecimalType(precision, scale)
    if kind == "wei":
        raise ContractError("256-bit integers (wei) cannot be stored without loss")
    raise ContractError(f"unknown data type {kind!r}")


def field_metadata(spec: dict[str, Any]) -> dict[str, Any]:
    meta: dict[str, Any] = {}
    if spec.get("data_type") == "timestamp" and spec.get("timezone", True) is False:
        if (spec.get("precision") or 0) > 6:
            meta["logical"] = NS_TIMESTAMP
    if spec.get("description"):
        meta["comment"] = spec["description"]
    return meta


def _time_type() -> T.DataType:
    return T.TimeType(6)  # type: ignore[attr-defined]


def _time_supported() -> bool:
    return hasattr(T, "TimeType")


# Decimal digits that the integer types need.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _holds(stored: T.DataType, incoming: T.DataType) -> bool:
    """Whether every value of ``incoming`` has an exact value of type ``stored``."""
    if stored == incoming or isinstance(incoming, T.NullType):
        return True
    whole = _DIGITS.get(type(incoming))
    if isinstance(stored, T.LongType):
        return whole is not None
    if isinstance(stored, T.DecimalType):
        if whole is not None:
            return stored.precision - stored.scale >= whole
        return (isinstance(incoming, T.DecimalType) and stored.scale >= incoming.scale
                and stored.precision - stored.scale >= incoming.precision - incoming.scale)
    if isinstance(stored, T.DoubleType):  # integers up to 2^53 are exact; wider ones are not taken
        return isinstance(incoming, T.FloatType) or (whole is not None and whole <= 10)
    if isinstance(stored, T.StringType):
        return not isinstance(incoming, T.BinaryType)
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(stored, dates[1:]) and isinstance(incoming, dates)


def widen(stored: T.DataType, incoming: T.DataType, where: str = "") -> T.DataType:
    """The type a stored column has after ``incoming`` values arrive: the stored one
    where it holds them exactly, DECIMAL(20,0) for unsigned 64-bit values in a BIGINT
    column, and else a refusal, as a cast would change values unnoticed."""
    if isinstance(stored, T.NullType):  # only NULLs so far: the first typed values decide
        return incoming
    if isinstance(stored, T.LongType) and incoming == UINT64_DECIMAL:
        return UINT64_DECIMAL
    if _holds(stored, incoming):
        return stored
    raise ContractError(f"{where}a {stored.simpleString()} column cannot take {incoming.simpleString()} values without loss")


def promote(incoming: T.DataType) -> T.DataType:
    """Narrow integers are stored as BIGINT."""
    if isinstance(incoming, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    return incoming
