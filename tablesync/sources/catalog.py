"""Column catalog of every tenant's tables, and the choices made from it.

The catalog is one DataFrame with a row per (tenant_id, table_name, column):
``ordinal_position, column_name, column_type, key_ordinal`` (position in the
primary key, NULL otherwise).  In production it is one JDBC read of
``INFORMATION_SCHEMA.COLUMNS`` for all tenants at once; every decision below
is a set-based aggregate over it instead of a per-table loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.types import base_type

CATALOG_COLUMNS = ("tenant_id", "table_name", "ordinal_position", "column_name",
                   "column_type", "key_ordinal")
TABLE_KEYS = ("tenant_id", "table_name")

# --- Fixed values: must equal the reference's lists -------------------------
# Watermark priority (live script), first match wins, case-insensitive.
TIMESTAMP_FIELDS = [
    "updated_at", "update_time", "last_updated", "modified_at", "last_modified",
    "created_at", "create_time", "insert_time", "timestamp", "sync_time",
]
# Name fragments that make a column a watermark candidate.
CANDIDATE_NAME_PARTS = ["time", "date", "created", "updated", "modified"]
# Name fragments that allow an integer (epoch) candidate.
EPOCH_NAME_PARTS = ["time", "created", "updated"]
# Types accepted by the information-schema pre-filter.
CATALOG_TYPES = ["timestamp", "datetime", "int", "bigint"]
# Older rule: names preferred when they contain one of these.
LEGACY_PREFERRED_PARTS = ["update", "modified"]
# Guide's rule: exact names, ranked 1..4 in this order, all others 5.
GUIDE_FIELDS = ["updated_at", "update_time", "last_updated", "created_at", "create_time",
                "insert_time", "timestamp", "sync_time", "modify_time"]
GUIDE_RANKED = ["updated_at", "update_time", "last_updated", "created_at"]
# --- end of fixed values ------------------------------------------------------

INTEGER_TYPES = ["int", "bigint", "tinyint", "smallint", "mediumint"]


def read_information_schema(spark: SparkSession, url: str, properties: dict,
                            schemas: Sequence[str] | None = None) -> DataFrame:
    """SC-13 (production form): the column catalog of all tenant databases
    in one JDBC query, keys included."""
    where = ""
    if schemas:
        quoted = ", ".join("'" + s.replace("'", "''") + "'" for s in schemas)
        where = f"WHERE c.TABLE_SCHEMA IN ({quoted})"
    query = f"""(SELECT c.TABLE_SCHEMA AS tenant_id, c.TABLE_NAME AS table_name,
                        c.ORDINAL_POSITION AS ordinal_position, c.COLUMN_NAME AS column_name,
                        c.COLUMN_TYPE AS column_type, k.ORDINAL_POSITION AS key_ordinal
                 FROM INFORMATION_SCHEMA.COLUMNS c
                 LEFT JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE k
                   ON k.TABLE_SCHEMA = c.TABLE_SCHEMA AND k.TABLE_NAME = c.TABLE_NAME
                  AND k.COLUMN_NAME = c.COLUMN_NAME AND k.CONSTRAINT_NAME = 'PRIMARY'
                 {where}) AS catalog"""
    return spark.read.jdbc(url, query, properties=properties)


def _contains_any(c: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def catalog_candidates(catalog: DataFrame) -> DataFrame:
    """SC-13: columns whose base type is timestamp, datetime, int or bigint."""
    return catalog.where(base_type(F.col("column_type")).isin(CATALOG_TYPES))


def is_watermark_candidate(name: Column, type_text: Column) -> Column:
    """Live rule: a time-like name, and a datetime/timestamp type or an
    integer type with an epoch-like name.  Integer types are matched by
    whole word (``point`` is not an integer)."""
    lname, ltype = F.lower(name), F.lower(F.trim(type_text))
    is_dt = ltype.startswith("datetime") | ltype.startswith("timestamp")
    is_int = base_type(type_text).isin(INTEGER_TYPES)
    return _contains_any(lname, CANDIDATE_NAME_PARTS) & (
        is_dt | (is_int & _contains_any(lname, EPOCH_NAME_PARTS)))


def _rank_in(lname: Column, names: Sequence[str], default: int) -> Column:
    expr = F.lit(default)
    for i, n in reversed(list(enumerate(names))):
        expr = F.when(lname == n, F.lit(i)).otherwise(expr)
    return expr


def _choose(catalog: DataFrame, candidate: Column, order: Column) -> DataFrame:
    """Best candidate per table by ``order`` (then position); tables without
    a candidate get NULL.  ``row_number() = 1`` over (tenant, table): the
    partial group limit keeps one row per table and map task before the
    shuffle, no join back."""
    w = Window.partitionBy(*TABLE_KEYS).orderBy(
        (~candidate).asc(), order.asc(), F.col("ordinal_position").asc())
    best = (catalog.withColumn("_cand", candidate)
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1))
    return best.select(*TABLE_KEYS,
                       F.when(F.col("_cand"), F.col("column_name")).alias("watermark_column"),
                       F.when(F.col("_cand"), F.col("column_type")).alias("watermark_type"))


def watermark_column(catalog: DataFrame, priority: Sequence[str] = TIMESTAMP_FIELDS) -> DataFrame:
    """W-01: candidates by name and type, then the priority list (exact,
    case-insensitive), else the first candidate by position."""
    cand = is_watermark_candidate(F.col("column_name"), F.col("column_type"))
    order = _rank_in(F.lower(F.col("column_name")), [p.lower() for p in priority], len(priority))
    return _choose(catalog, cand, order)


def watermark_column_legacy(catalog: DataFrame) -> DataFrame:
    """W-02: time-like name with type timestamp/datetime/int/bigint; prefer
    names containing ``update`` or ``modified``, else the first by position."""
    lname = F.lower(F.col("column_name"))
    cand = (base_type(F.col("column_type")).isin(CATALOG_TYPES)
            & _contains_any(lname, CANDIDATE_NAME_PARTS))
    order = F.when(_contains_any(lname, LEGACY_PREFERRED_PARTS), F.lit(0)).otherwise(F.lit(1))
    return _choose(catalog, cand, order)


def watermark_column_exact(catalog: DataFrame) -> DataFrame:
    """W-03: exact names only; rank 1-4 for the first four, 5 for the rest;
    position breaks ties."""
    lname = F.lower(F.col("column_name"))
    cand = lname.isin(GUIDE_FIELDS)
    order = _rank_in(lname, GUIDE_RANKED, len(GUIDE_RANKED)) + 1
    return _choose(catalog, cand, order)


def key_columns(catalog: DataFrame) -> DataFrame:
    """A-14: primary-key columns of each table in key order (array)."""
    keyed = catalog.where(F.col("key_ordinal").isNotNull())
    return (keyed.groupBy(*TABLE_KEYS)
            .agg(F.sort_array(F.collect_list(F.struct("key_ordinal", "column_name"))).alias("_k"))
            .select(*TABLE_KEYS, F.transform("_k", lambda s: s["column_name"]).alias("key_columns")))


def table_facts(catalog: DataFrame, priority: Sequence[str] = TIMESTAMP_FIELDS) -> DataFrame:
    """Per table: watermark column/type (W-01), column count and key columns
    (A-14, NULL when the table has no key), in one aggregation pass."""
    cand = is_watermark_candidate(F.col("column_name"), F.col("column_type"))
    order = _rank_in(F.lower(F.col("column_name")), [p.lower() for p in priority], len(priority))
    best = F.min_by(
        F.struct(F.col("column_name"), F.col("column_type")),
        F.struct((~cand).alias("miss"), order.alias("o"), F.col("ordinal_position").alias("p")))
    key_entry = F.when(F.col("key_ordinal").isNotNull(),
                       F.struct(F.col("key_ordinal"), F.col("column_name")))
    g = catalog.groupBy(*TABLE_KEYS).agg(
        best.alias("_b"), (F.max(cand.cast("int")) == 1).alias("_any"),
        F.count(F.lit(1)).alias("column_count"),
        F.sort_array(F.collect_list(key_entry)).alias("_k"))
    keys = F.transform("_k", lambda e: e["column_name"])
    return g.select(*TABLE_KEYS,
                    F.when(F.col("_any"), F.col("_b.column_name")).alias("watermark_column"),
                    F.when(F.col("_any"), F.col("_b.column_type")).alias("watermark_type"),
                    "column_count",
                    F.when(F.size("_k") > 0, keys).alias("key_columns"))


# Spark type -> source-style type text, so DataFrame sources can be described
# like a database table (the ``DESCRIBE`` analogue for Parquet/JDBC frames).
def _type_text(dt) -> str:
    from pyspark.sql import types as T
    if isinstance(dt, T.LongType):
        return "bigint(20)"
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return "int(11)"
    if isinstance(dt, T.DoubleType):
        return "double"
    if isinstance(dt, T.FloatType):
        return "float"
    if isinstance(dt, T.DecimalType):
        return f"decimal({dt.precision},{dt.scale})"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, T.BinaryType):
        return "blob"
    if isinstance(dt, T.BooleanType):
        return "tinyint(1)"
    return "text"


def describe_sources(sources: dict, keys: dict | None = None,
                     tenant_col: str = "tenant_id") -> DataFrame:
    """Catalog rows for DataFrame sources: every tenant present in a table's
    source gets that table's columns (schema from the DataFrame, keys from
    ``keys[table]``).  The tenant list is a distinct over the source; the
    column template is fixed by the schema and joined by broadcast."""
    from ..functions.literal import literal_frame
    out = None
    for table, df in sources.items():
        kl = list((keys or {}).get(table, []))
        rows = [(table, i + 1, f.name, _type_text(f.dataType), (kl.index(f.name) + 1) if f.name in kl else None)
                for i, f in enumerate(df.schema.fields) if f.name != tenant_col]
        tmpl = literal_frame(df.sparkSession, rows, "table_name string, ordinal_position int, "
                             "column_name string, column_type string, key_ordinal int")
        tenants = df.select(tenant_col).distinct().withColumnRenamed(tenant_col, "tenant_id") \
            .withColumn("table_name", F.lit(table))
        part = tenants.join(F.broadcast(tmpl), "table_name").select(*CATALOG_COLUMNS)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no sources")
    return out
