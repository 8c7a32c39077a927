"""Small fixed tables as JVM-side literals (no Python worker, no RDD).

The rows become one SQL ``VALUES`` inline table, resolved by the analyzer into
a ``LocalRelation`` (``LocalTableScan``): one parser call instead of a
column expression per cell, so building the frame costs milliseconds on the
driver.  The table is part of the query plan, its size is fixed by the code,
and broadcasting it is always safe.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L" if abs(v) >= 2 ** 31 else str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    if isinstance(v, decimal.Decimal):
        return f"{v}BD"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    fields = st.fields
    names = [f"c{i}" for i in range(len(fields))]
    if rows:
        values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
        source = f"VALUES {values} AS t({', '.join(names)})"
    else:
        source = "(SELECT " + ", ".join(f"NULL AS {n}" for n in names) + " WHERE FALSE)"
    cols = ", ".join(f"CAST({n} AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for n, f in zip(names, fields))
    return spark.sql(f"SELECT {cols} FROM {source}")
