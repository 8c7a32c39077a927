"""Per-value conversions as built-in Spark expressions (no Python UDFs).

Each function takes a Column and returns a Column, so they fuse into the
surrounding whole-stage-codegen projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import TARGET_TO_SPARK


def _is_string(dtype: T.DataType | None) -> bool:
    return dtype is None or isinstance(dtype, T.StringType)


def empty_to_null(c: Column) -> Column:
    """PR-03: empty text is NULL before a numeric cast."""
    return F.nullif(c, F.lit(""))


# Shapes a number's text can have (supersets of what ``try_cast`` accepts:
# trimmed spaces/controls, sign, digits; decimals accept any Unicode digit).
# Text outside the shape is NULL without calling the cast: for such text the
# ANSI cast builds and catches an exception per value, the slow path when a
# column holds much junk.  Text inside the shape is still decided by the cast.
_PAD = r"[\p{Cc}\p{Z}\s]*"
INTEGER_SHAPE = rf"^{_PAD}[+-]?[0-9]+{_PAD}$"
DECIMAL_SHAPE = rf"^{_PAD}[+-]?[\p{{Nd}}.]+([eE][+-]?\p{{Nd}}+)?{_PAD}$"
FLOAT_HINT = r"(?i)[0-9]|inf|nan"


def _guarded(c: Column, shape: str, to: str | T.DataType) -> Column:
    s = empty_to_null(c)
    return F.when(s.rlike(shape), s.try_cast(to))


def to_int64(c: Column, dtype: T.DataType | None = None) -> Column:
    """Integer target.  Text: '' -> NULL, '12.5'/'abc' -> NULL (bad value);
    numbers: fractions are truncated toward zero."""
    if _is_string(dtype):
        return _guarded(c, INTEGER_SHAPE, "bigint")
    return c.try_cast("bigint")


def to_float64(c: Column, dtype: T.DataType | None = None) -> Column:
    if _is_string(dtype):
        return _guarded(c, FLOAT_HINT, "double")
    return c.try_cast("double")


def to_numeric(c: Column, dtype: T.DataType | None = None) -> Column:
    if _is_string(dtype):
        return _guarded(c, DECIMAL_SHAPE, T.DecimalType(38, 9))
    return c.try_cast(T.DecimalType(38, 9))


def to_boolean(c: Column, dtype: T.DataType | None = None) -> Column:
    """PR-09: booleans stay; numbers -> <> 0; text of digits only -> <> 0;
    any other text -> non-empty."""
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, (T.NumericType,)):
        return c != 0
    s = c.cast("string")
    return (
        F.when(s.isNull(), F.lit(None).cast("boolean"))
        .when(s.rlike(r"^[0-9]+$"), ~s.rlike(r"^0+$"))
        .otherwise(F.length(s) > 0)
    )


def iso_text(c: Column) -> Column:
    """PR-07: ISO-8601 text of a naive timestamp, microseconds only if set."""
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(c.isNull(), F.lit(None).cast("string")).when(
        micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros))


def date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def epoch_to_timestamp(c: Column) -> Column:
    """PR-08: epoch seconds -> naive UTC timestamp (session zone is UTC)."""
    return F.timestamp_seconds(c).cast("timestamp_ntz")


def timestamp_to_epoch(c: Column) -> Column:
    """Naive timestamp -> epoch seconds (floor), as UNIX_TIMESTAMP does."""
    return F.unix_timestamp(c)


def parse_timestamp(c: Column) -> Column:
    """ISO text -> naive timestamp; unparsable text -> NULL."""
    return c.try_cast("timestamp_ntz")


def to_target(c: Column, target: str, dtype: T.DataType | None = None,
              source_type: str = "") -> Column:
    """Convert one column to its target type (PR-02)."""
    if target == "INT64":
        return to_int64(c, dtype)
    if target == "FLOAT64":
        return to_float64(c, dtype)
    if target == "NUMERIC":
        return to_numeric(c, dtype)
    if target == "BOOLEAN":
        return to_boolean(c, dtype)
    if target == "TIMESTAMP":
        if isinstance(dtype, T.IntegralType):
            return epoch_to_timestamp(c)
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return c.cast("timestamp_ntz")
        return parse_timestamp(c.cast("string"))
    if target == "DATE":
        if isinstance(dtype, T.DateType):
            return c
        return c.cast("string").try_cast("date") if _is_string(dtype) else c.try_cast("date")
    if target == "BYTES":
        if isinstance(dtype, T.BinaryType):
            return c
        return c.cast("string").cast("binary")
    return c.cast(TARGET_TO_SPARK.get(target, T.StringType()))
