"""Typed time literals and interval helpers.

Bounds are built as literals of the column's own type so that the comparison
stays on the raw column and is pushed to the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = datetime(1970, 1, 1)


def as_datetime(value: datetime | date | str) -> datetime:
    if isinstance(value, datetime):
        return value.replace(tzinfo=None) if value.tzinfo is None else \
            value.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(str(value).replace("T", " "))


def iso(value: datetime | date | str) -> str:
    return as_datetime(value).isoformat(sep=" ")


def ts_lit(value: datetime | date | str) -> Column:
    """Naive-timestamp literal (``TIMESTAMP_NTZ``), constant-folded."""
    return F.lit(iso(value)).cast("timestamp_ntz")


def epoch_seconds(value: datetime | date | str) -> int:
    """Seconds since 1970 of a naive UTC time (floor, like ``int(ts)``)."""
    delta = as_datetime(value) - EPOCH
    return delta.days * 86400 + delta.seconds


def bound_for(dtype: T.DataType, value: datetime | date | str) -> Column:
    """A literal bound of the column's type: epoch seconds for integer
    watermark columns, a naive timestamp otherwise."""
    if isinstance(dtype, T.IntegralType):
        return F.lit(epoch_seconds(value)).cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return F.lit(iso(value)).cast("timestamp")
    if isinstance(dtype, T.DateType):
        return F.lit(as_datetime(value).date().isoformat()).cast("date")
    return ts_lit(value)


def minus(value: datetime | date | str, minutes: float = 0, hours: float = 0,
          days: float = 0) -> datetime:
    return as_datetime(value) - timedelta(minutes=minutes, hours=hours, days=days)
