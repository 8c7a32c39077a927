"""Source (MySQL) type text -> target type, as Spark expressions.

The map is applied as a broadcast join against a fixed 24-row table so that
a catalog of millions of (tenant, table, column) rows is typed in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .literal import literal_frame

# --- Fixed values: must equal the reference's type map ---------------------
# source base type -> target type; anything not listed becomes STRING.
MYSQL_TO_TARGET = {
    "int": "INT64",
    "bigint": "INT64",
    "tinyint": "INT64",
    "smallint": "INT64",
    "mediumint": "INT64",
    "decimal": "NUMERIC",
    "numeric": "NUMERIC",
    "float": "FLOAT64",
    "double": "FLOAT64",
    "varchar": "STRING",
    "char": "STRING",
    "text": "STRING",
    "mediumtext": "STRING",
    "longtext": "STRING",
    "date": "DATE",
    "datetime": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "time": "STRING",
    "json": "STRING",
    "blob": "BYTES",
    "binary": "BYTES",
    "varbinary": "BYTES",
    "enum": "STRING",
    "set": "STRING",
}
# --- end of fixed values ----------------------------------------------------

FALLBACK_TARGET = "STRING"

# Target type -> Spark type.  NUMERIC keeps exact decimals (the reference
# went through float); TIMESTAMP stays naive (NTZ) like the source values.
TARGET_TO_SPARK: dict[str, T.DataType] = {
    "INT64": T.LongType(),
    "NUMERIC": T.DecimalType(38, 9),
    "FLOAT64": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "BYTES": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
}


def base_type(type_text: Column) -> Column:
    """``bigint(20) unsigned`` -> ``bigint``; ``int unsigned`` -> ``int``."""
    head = F.lower(F.trim(F.substring_index(type_text, "(", 1)))
    return F.trim(F.regexp_replace(head, r"\s+(unsigned|zerofill)\b", ""))


def base_type_py(type_text: str) -> str:
    """Driver-side twin of :func:`base_type` for small per-table configs."""
    head = type_text.split("(")[0].strip().lower()
    for suffix in (" unsigned", " zerofill"):
        head = head.replace(suffix, "")
    return head.strip()


def target_type_py(type_text: str) -> str:
    return MYSQL_TO_TARGET.get(base_type_py(type_text), FALLBACK_TARGET)


def type_map_frame(spark: SparkSession) -> DataFrame:
    """The fixed map as a 24-row DataFrame (size bounded: safe to broadcast)."""
    rows = sorted(MYSQL_TO_TARGET.items())
    return literal_frame(spark, rows, "source_base_type string, _mapped_target string")


def map_types(catalog: DataFrame, type_col: str = "column_type",
              out_col: str = "target_type") -> DataFrame:
    """PR-13: add the target type for every catalog row (STRING fallback)."""
    spark = catalog.sparkSession
    tm = F.broadcast(type_map_frame(spark))
    return (
        catalog.withColumn("source_base_type", base_type(F.col(type_col)))
        .join(tm, "source_base_type", "left")
        .withColumn(out_col, F.coalesce(F.col("_mapped_target"), F.lit(FALLBACK_TARGET)))
        .drop("_mapped_target")
    )
