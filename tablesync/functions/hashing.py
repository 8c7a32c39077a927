"""Row hash (PR-10): MD5 over the name-sorted, canonical text of a row's data.

Canonical text is exact and any engine can reproduce it: a double is its sign,
53-bit mantissa and binary exponent (NaN, infinities and zero by name), a
timestamp has six fractional digits.  NULL is ``N``, any other value ``V``, the
length of its text, ``:`` and the text, so no text can pass for NULL or for two
columns.  System columns are left out (but for the tenant): the same data
hashes alike whatever run loaded it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_SEP = "\x1f"
NULL_MARK = "N"
DEFAULT_EXCLUDE = ("sync_timestamp", "sync_mode", "sync_date", "key_bucket", "data_hash")


def double_text(c: Column) -> Column:
    """Exact text of a double: mantissa ``p`` exponent.  ``log2`` may be off by
    one near a power of two; scaling by a power of two is exact, so the
    mantissa says so and both are put right."""
    a = F.nullif(F.abs(c), F.lit(0.0))
    e = F.floor(F.log2(a))
    m = a / F.pow(F.lit(2.0), e)
    shift = F.when(m >= 2, 1).when(m < 1, -1).otherwise(0)
    mantissa = (m / F.pow(F.lit(2.0), shift) * F.lit(float(1 << 52))).cast("bigint")
    return (F.when(F.isnan(c), F.lit("nan"))
            .when(F.abs(c) == float("inf"), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(c == 0, F.lit("0"))
            .when(c.isNotNull(), F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), mantissa.cast("string"),
                                          F.lit("p"), (e + shift).cast("bigint").cast("string"))))


def canonical_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        txt = double_text(c.cast("double"))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        txt = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(dtype, T.DateType):
        txt = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(dtype, T.BinaryType):
        txt = F.lower(F.hex(c))
    elif isinstance(dtype, T.BooleanType):
        txt = F.when(c, F.lit("true")).when(~c, F.lit("false"))
    else:
        txt = c.cast("string")
    marked = F.concat(F.lit("V"), F.length(txt).cast("string"), F.lit(":"), txt)
    return F.coalesce(marked, F.lit(NULL_MARK))


def hash_columns(df: DataFrame, exclude: Iterable[str] = DEFAULT_EXCLUDE) -> list[str]:
    skip = set(exclude)
    return sorted(f.name for f in df.schema.fields if f.name not in skip)


def row_hash(df: DataFrame, exclude: Iterable[str] = DEFAULT_EXCLUDE,
             columns: Iterable[str] | None = None) -> Column:
    """Column expression for the MD5 hex hash of each row of ``df``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = sorted(columns) if columns is not None else hash_columns(df, exclude)
    parts = [F.concat(F.lit(f"{n}="), canonical_text(F.col(f"`{n}`"), types[n])) for n in names]
    return F.md5(F.concat_ws(HASH_SEP, *parts))


def with_row_hash(df: DataFrame, out: str = "data_hash",
                  exclude: Iterable[str] = DEFAULT_EXCLUDE) -> DataFrame:
    """Add (or recompute) the hash column; the old hash is never an input."""
    exclude = set(exclude) | {out}
    base = df.drop(out) if out in df.columns else df
    return base.withColumn(out, row_hash(base, exclude))
