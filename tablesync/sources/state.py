"""Sync-state documents: one JSON per tenant (current) and one JSON per
tenant and table (old layout).  Read with an explicit schema, never inferred;
a missing or broken file gives no rows for its tenant (PERMISSIVE mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_STATE = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("last_sync_time", T.StringType()),
    T.StructField("sync_status", T.StringType()),
    T.StructField("sync_mode", T.StringType()),
    T.StructField("records_synced", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])

TENANT_DOC = T.StructType([
    T.StructField("database_info", T.StructType([
        T.StructField("tenant_id", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("total_tables", T.IntegerType()),
    ])),
    T.StructField("tables", T.MapType(T.StringType(), TABLE_STATE)),
])

STATE_COLUMNS = ["tenant_id"] + [f.name for f in TABLE_STATE.fields]

# Old layout file name: ``{tenant}_{table}.json`` - tenant is the part before
# the first underscore, table the rest.  Also accepted: a directory of that
# name holding part files (as Spark writes).
LEGACY_NAME = r"(?:/|=)([^/_=]+)_([^/=]+?)\.json(?:/[^/]*)?$"


def status_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SC-14: every tenant document under ``path`` as one row per
    (tenant, table).  The tenant comes from ``database_info``; a document
    without it falls back to the file name."""
    docs = (spark.read.schema(TENANT_DOC).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path)
            .withColumn("_file", F.input_file_name()))
    by_dir = F.regexp_extract(F.col("_file"), r"/tenant_id=([^/]+)/[^/]*$", 1)
    by_name = F.regexp_extract(F.col("_file"), r"/([^/=]+?)\.json$", 1)
    fname = F.when(by_dir != "", by_dir).when(by_name != "", by_name)
    return (docs.where(F.col("tables").isNotNull())
            .select(F.coalesce(F.col("database_info.tenant_id"), fname).alias("tenant_id"),
                    F.explode("tables").alias("_table_key", "s"))
            .select("tenant_id",
                    F.coalesce(F.col("s.table_name"), F.col("_table_key")).alias("table_name"),
                    *[F.col(f"s.{f.name}") for f in TABLE_STATE.fields if f.name != "table_name"]))


def legacy_status_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SC-15: old per-table files; tenant and table come from the file name,
    records without ``table_name`` are skipped."""
    rows = (spark.read.schema(TABLE_STATE).option("multiLine", multi_line)
            .option("recursiveFileLookup", "true").json(path)
            .withColumn("_file", F.input_file_name()))
    return (rows.where(F.col("table_name").isNotNull())
            .select(F.regexp_extract("_file", LEGACY_NAME, 1).alias("tenant_id"),
                    F.regexp_extract("_file", LEGACY_NAME, 2).alias("file_table"),
                    *[F.col(f.name) for f in TABLE_STATE.fields])
            .where(F.col("tenant_id") != ""))


def tenant_documents(current: DataFrame, run_time_text: str | None = None) -> DataFrame:
    """The per-tenant document of the current state: ``database_info`` and a
    ``tables`` map keyed by table name.  One row per tenant; its size is
    bounded by the number of tables of that tenant (metadata, not data)."""
    entry = F.struct(F.col("table_name").alias("key"),
                     F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name)
                               for f in TABLE_STATE.fields]).alias("value"))
    last = F.lit(run_time_text) if run_time_text else F.max("updated_at")
    return (current.groupBy("tenant_id")
            .agg(F.map_from_entries(F.collect_list(entry)).alias("tables"),
                 F.count(F.lit(1)).cast("int").alias("_n"), last.alias("_last"))
            .select("tenant_id",
                    F.struct(F.col("tenant_id"), F.col("_last").alias("last_updated"),
                             F.col("_n").alias("total_tables")).alias("database_info"),
                    "tables"))


def write_status_documents(docs: DataFrame, path: str, one_file_per_tenant: bool = True,
                           files: int | None = None) -> None:
    """Tenant documents as JSON.

    ``one_file_per_tenant``: the reference's layout (``{tenant}`` directory
    holding one single-document file; read with ``multi_line=True``).  Cost
    is per file, so with very many tenants prefer ``False``: JSON lines, many
    tenants per file, ``files`` files (read with ``multi_line=False``)."""
    if one_file_per_tenant:
        (docs.repartition("tenant_id")
         .write.mode("overwrite").partitionBy("tenant_id").json(path))
    else:
        out = docs.repartition(files, "tenant_id") if files else docs
        out.write.mode("overwrite").json(path)
