"""Canonical codes of key values.

``value_code`` writes a value of a known type as text whose byte order is the order of the values, so that
equal values have one code and different ones never share it, whatever the session's time zone:

* integers and decimals: sign, number of whole digits, digits (negative ones complemented), so a BIGINT and
  a DECIMAL(20,0) of equal value have equal codes;
* dates and timestamps: their days or microseconds as an integer;
* doubles: sign, exponent and 17 digits; -0.0 is 0.0, NaN comes last;
* text and binary: hexadecimal, ended by a blank; nested values as the text of their JSON.

Every code ends by itself, so codes of several columns can be put one after another; ``key_code`` does so, with
NULL before all values.  A key must first be cast to the type its table stores (``plans.load`` does), then a key
that arrives as DATE meets the stored TIMESTAMP, and an INT the stored TEXT.

``directory_code`` is the form of a single value that names a partition folder: as above, but text stays readable
and is cut after ``DIRECTORY_CHARS`` characters.  A cut never changes the order, so ranges can be tested on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIRECTORY_CHARS = 40
_DIGITS, _COMPLEMENT = "0123456789", "9876543210"


def _whole_number(n: Column) -> Column:
    """Code of a DECIMAL(38,0)."""
    return _signed(n < 0, F.abs(n).cast("string"), None)


def _signed(negative: Column, digits: Column, fraction: Column | None) -> Column:
    length = F.length(digits)
    every = digits if fraction is None else F.concat(digits, fraction)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.when(negative, F.concat(F.lit("n"), two(F.lit(99) - length), F.translate(every, _DIGITS, _COMPLEMENT))) \
        .otherwise(F.concat(F.lit("p"), two(length), every))


def _decimal(c: Column, dtype: T.DecimalType) -> Column:
    if dtype.scale == 0:
        return _whole_number(c.cast("decimal(38,0)"))
    whole = dtype.precision - dtype.scale
    text = F.to_char(F.abs(c), F.lit("0" * whole + "D" + "0" * dtype.scale))  # every digit, never an exponent
    digits = F.regexp_replace(F.substring_index(text, ".", 1), "^ *0*", "")
    digits = F.when(digits == "", "0").otherwise(digits)
    return _signed(c < F.lit(0).cast(dtype), digits, F.substring_index(text, ".", -1))


def _double(c: Column) -> Column:
    c = c.cast("double") + F.lit(0.0)
    text = F.format_string("%.16e", F.abs(c))
    mantissa = F.regexp_replace(F.substring_index(text, "e", 1), "\\.", "")
    exponent = F.substring_index(text, "e", -1).try_cast("int") + 400
    digits = F.when(c == 0, F.lit("0" * 20)).otherwise(F.concat(F.lpad(exponent.cast("string"), 3, "0"), mantissa))
    infinite = F.lit(float("inf"))
    return (F.when(F.isnan(c), "r").when(c == infinite, "q").when(c == -infinite, "m")
            .when(c < 0, F.concat(F.lit("n"), F.translate(digits, _DIGITS, _COMPLEMENT))).otherwise(F.concat(F.lit("p"), digits)))


def _micros_of_day(c: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), c).cast("decimal(38,6)")
    return (F.hour(c) * 3600 + F.minute(c) * 60).cast("decimal(38,0)") * 1_000_000 + (seconds * 1_000_000)


def _plain_code(c: Column, dtype: T.DataType) -> Column | None:
    """Code of the types whose code ends by itself; None for texts."""
    if isinstance(dtype, T.IntegralType):
        return _whole_number(c.cast("decimal(38,0)"))
    if isinstance(dtype, T.DecimalType):
        return _decimal(c, dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _double(c)
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "1").otherwise("0")
    if isinstance(dtype, T.DateType):
        return _whole_number(F.unix_date(c).cast("decimal(38,0)"))
    if isinstance(dtype, T.TimestampType):
        return _whole_number(F.unix_micros(c).cast("decimal(38,0)"))
    if isinstance(dtype, T.TimestampNTZType):
        days = F.unix_date(c.cast("date")).cast("decimal(20,0)")
        return _whole_number((days * 86_400_000_000 + _micros_of_day(c)).cast("decimal(38,0)"))
    return None


def _text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return c
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)) or type(dtype).__name__ == "VariantType":
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c.cast("string")


def value_code(c: Column, dtype: T.DataType) -> Column:
    """Code of one value; NULL for NULL."""
    code = _plain_code(c, dtype)
    if code is None:
        code = F.concat(F.hex(_text(c, dtype)), F.lit(" "))
    return F.when(c.isNotNull(), code)


def key_code(columns: Sequence[Column], types: Sequence[T.DataType]) -> Column:
    """Code of a key of several columns; never NULL."""
    parts = [F.coalesce(F.concat(F.lit("1"), value_code(c, t)), F.lit("0")) for c, t in zip(columns, types, strict=True)]
    return F.concat(*parts)


def directory_code(c: Column, dtype: T.DataType) -> Column:
    """Text that names the partition folder of a value; never empty or NULL, in the order of the values."""
    code = _plain_code(c, dtype)
    if code is None:
        text = F.hex(c) if isinstance(dtype, T.BinaryType) else _text(c, dtype)
        code = F.translate(F.substring(text, 1, DIRECTORY_CHARS), "\x00", "\x01")  # no path holds U+0000
    return F.when(c.isNull(), "n").otherwise(F.concat(F.lit("v"), code))
