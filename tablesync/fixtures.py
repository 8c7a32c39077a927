"""Inputs for the registered queries, derived by Spark from the given tables.

Tenants, tables, catalogs and control records are all built from ``orders``,
``events``, ``lineitem`` and ``customer``, so every query's work grows with
the data.  The catalog uses a small fixed template of table layouts (the
reference's documented tables plus one table per watermark rule); each
customer is a tenant holding the first ``1 + custkey % 9`` of them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.hashing import with_row_hash
from .functions.literal import literal_frame
from .functions.timeutil import ts_lit
from .operators.transform import add_system_columns
from .plans.control import current_status
from .sources.scans import incremental_window

RUN_TIME = "2025-01-01 00:00:00"
ORDERS_LAST = "1998-01-01 00:00:00"
ORDERS_NOW = "1999-01-01 00:00:00"
ORDERS_LOOKBACK_MIN = 30 * 24 * 60
EVENTS_LAST = "2024-01-15 00:00:00"
EVENTS_NOW = "2024-01-22 00:00:00"
EVENTS_TARGET_END = "2024-01-20 00:00:00"
EVENTS_BOOTSTRAP_NOW = "2024-01-30 23:57:12.194062"
CATALOG_TABLES = 9
CATALOG_TENANTS_PER_TASK = 16384

# Table layouts of the catalog template:
# (table_idx, table_name, ordinal_position, column_name, column_type, key_ordinal)
CATALOG_TEMPLATE = [
    (1, "users", 1, "id", "bigint(20)", 1),
    (1, "users", 2, "username", "varchar(64)", None),
    (1, "users", 3, "email", "varchar(128)", None),
    (1, "users", 4, "phone", "varchar(32)", None),
    (1, "users", 5, "status", "varchar(16)", None),
    (1, "users", 6, "created_at", "datetime", None),
    (1, "users", 7, "updated_at", "timestamp", None),
    (2, "orders", 1, "order_id", "bigint(20)", 1),
    (2, "orders", 2, "user_id", "bigint(20)", None),
    (2, "orders", 3, "total_amount", "decimal(12,2)", None),
    (2, "orders", 4, "order_status", "varchar(16)", None),
    (2, "orders", 5, "payment_status", "varchar(16)", None),
    (2, "orders", 6, "create_time", "int(11)", None),
    (2, "orders", 7, "update_time", "int(11)", None),
    (3, "products", 1, "product_id", "bigint(20)", 1),
    (3, "products", 2, "product_name", "varchar(255)", None),
    (3, "products", 3, "category_id", "bigint(20)", None),
    (3, "products", 4, "price", "decimal(10,2)", None),
    (3, "products", 5, "stock_quantity", "int(11)", None),
    (3, "products", 6, "status", "varchar(16)", None),
    (3, "products", 7, "created_at", "datetime", None),
    (3, "products", 8, "last_updated", "datetime", None),
    (4, "order_status_log", 1, "log_id", "bigint(20) unsigned", 1),
    (4, "order_status_log", 2, "order_id", "bigint(20)", None),
    (4, "order_status_log", 3, "status", "varchar(16)", None),
    (4, "order_status_log", 4, "update_time", "datetime(6)", None),
    (5, "logs", 1, "id", "bigint unsigned", None),
    (5, "logs", 2, "message", "text", None),
    (5, "logs", 3, "created_at", "datetime", None),
    (6, "daily_stats", 1, "stat_date", "date", None),
    (6, "daily_stats", 2, "x", "date", None),
    (6, "daily_stats", 3, "amount", "double", None),
    (7, "legacy_counters", 1, "id", "int(11)", 1),
    (7, "legacy_counters", 2, "last_modified", "int(11)", None),
    (7, "legacy_counters", 3, "hits", "int unsigned", None),
    (8, "geo", 1, "id", "int", 1),
    (8, "geo", 2, "startpoint_time", "point", None),
    (8, "geo", 3, "name", "varchar(20)", None),
    (9, "kv", 1, "k", "varchar(64)", 1),
    (9, "kv", 2, "k2", "int(11)", 2),
    (9, "kv", 3, "v", "json", None),
]

# Table name of a control record, by order priority.
PRIORITY_TABLE = [("1-URGENT", "users"), ("2-HIGH", "orders"), ("3-MEDIUM", "products"),
                  ("4-NOT SPECIFIED", "order_status_log"), ("5-LOW", "logs")]

# Field types of the ``dirty`` fixture's columns (PR-02..05, A-06).
DIRTY_TYPES = {"o_orderkey": "bigint(20)", "v_int": "int(11)", "v_double": "double",
               "v_decimal": "decimal(12,2)", "v_text": "varchar(20)"}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def fo(spark, d):
    o = table(spark, d, "orders")
    return o.withColumn("tenant_id", F.col("o_orderpriority"))


def fo_changed(spark, d):
    """Orders whose rows after (last - lookback) changed price."""
    start = ts_lit("1997-12-02 00:00:00")
    return fo(spark, d).withColumn(
        "o_totalprice", F.when(F.col("o_orderdate") > start, F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")))


def target_orders(spark, d):
    return fo(spark, d).where(F.col("o_orderdate") <= ts_lit(ORDERS_LAST))


def source_orders(spark, d):
    return incremental_window(fo_changed(spark, d), "o_orderdate", ORDERS_LAST, ORDERS_NOW,
                              ORDERS_LOOKBACK_MIN)


def fe(spark, d):
    e = table(spark, d, "events")
    return e.select(
        "event_id", "ts", F.unix_timestamp("ts").alias("event_time"),
        F.concat(F.lit("shop"), (F.col("user_id") % 3 + 1).cast("string")).alias("tenant_id"),
        "event_type", "value", "props")


def events_target(spark, d):
    return fe(spark, d).where(F.col("ts") <= ts_lit(EVENTS_TARGET_END))


def fl(spark, d):
    return table(spark, d, "lineitem").withColumn("tenant_id", F.col("l_returnflag"))


def fo_null(spark, d):
    return fo(spark, d).withColumn(
        "o_orderkey", F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"),
                             F.lit(None).cast("bigint"))
        .otherwise(F.col("o_orderkey")))


def dirty(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey") % 5
    raw = (F.when(k == 0, F.lit("")).when(k == 1, F.lit("abc")).when(k == 2, F.lit("12.5"))
           .when(k == 3, F.col("o_orderkey").cast("string")))
    return o.select("o_orderkey", raw.alias("raw"))


def dirty_wide(spark, d):
    x = dirty(spark, d)
    return x.select("o_orderkey", *[F.col("raw").alias(c) for c in
                                    ("v_int", "v_double", "v_decimal", "v_text")])


def hashed_target(spark, d):
    """Rows loaded at the last sync, with their hash."""
    return with_row_hash(target_orders(spark, d))


def hashed_source(spark, d):
    return with_row_hash(fo(spark, d))


def narrow_target(spark, d):
    return target_orders(spark, d).drop("o_orderstatus").withColumn("note", F.lit("keep"))


def catalog(spark, d):
    tmpl = literal_frame(
        spark, CATALOG_TEMPLATE, "table_idx int, table_name string, ordinal_position int, "
                          "column_name string, column_type string, key_ordinal int")
    # A customer becomes up to 41 catalog rows, and a file of a million customers
    # is one task.  They are dealt out evenly (repeated keys too) while they are
    # one narrow column, so that the sorts and aggregates per table, which begin
    # in these tasks, hold as many rows a task whatever the size.
    c = table(spark, d, "customer").select("c_custkey")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(c.count() / CATALOG_TENANTS_PER_TASK))
    tenants = c.repartition(tasks).select(
        F.concat(F.lit("shop"), F.col("c_custkey").cast("string")).alias("tenant_id"),
        F.explode(F.sequence(F.lit(1), (F.lit(1) + F.pmod("c_custkey", F.lit(CATALOG_TABLES)))
                             .cast("int"))).alias("table_idx"))
    # the template has a fixed size (41 rows): broadcasting it is bounded
    return (tenants.join(F.broadcast(tmpl), "table_idx")
            .select("tenant_id", "table_name", "ordinal_position", "column_name",
                    "column_type", "key_ordinal"))


def _priority_table():
    expr = F.lit(None).cast("string")
    for p, t in reversed(PRIORITY_TABLE):
        expr = F.when(F.col("o_orderpriority") == p, F.lit(t)).otherwise(expr)
    return expr


def history(spark, d, orders: DataFrame | None = None, tenant=None):
    """Control records: one per order (a sync run of one tenant table).
    Tenant: the customer (default) or a given column expression."""
    o = orders if orders is not None else table(spark, d, "orders")
    at = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey").cast("double"))
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    failed = (F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 7 == 0)
    tenant = tenant if tenant is not None else F.concat(F.lit("shop"), F.col("o_custkey").cast("string"))
    return o.select(
        tenant.alias("tenant_id"),
        _priority_table().alias("table_name"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("not-a-time"))
        .when(F.col("o_orderkey") % 89 == 0, F.lit(None).cast("string"))
        .otherwise(iso).alias("last_sync_time"),
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("sync_status"),
        F.when(F.col("o_orderstatus") == "F", F.lit("FULL")).otherwise(F.lit("INCREMENTAL"))
        .alias("sync_mode"),
        F.when(failed, F.lit(0)).otherwise(F.col("o_totalprice").cast("bigint"))
        .cast("bigint").alias("records_synced"),
        F.when(failed, F.lit("timeout")).alias("error_message"),
        iso.alias("updated_at"))


def current(spark, d):
    return current_status(history(spark, d))


def history_by_nation(spark, d):
    """Control records of all orders with the customer's nation as tenant:
    state documents are files per tenant, so their count follows the tenant
    count (25), while every order still feeds them."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    oc = o.join(c, "o_custkey")
    return history(spark, d, oc, F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")))


def current_by_nation(spark, d):
    return current_status(history_by_nation(spark, d))


def run_stats(spark, d):
    h = history(spark, d)
    return h.select(
        F.col("tenant_id").alias("database"), "table_name", F.col("sync_status").alias("status"),
        "sync_mode", "records_synced",
        F.col("updated_at").try_cast("timestamp_ntz").alias("started_at"),
        (F.col("records_synced") % 120).cast("double").alias("duration_sec"))


def loaded_orders(spark, d):
    """A target loaded twice: all tenants at one time, two tenants again later."""
    a = add_system_columns(fo(spark, d), None, "2024-06-01 00:00:00", "FULL")
    b = add_system_columns(source_orders(spark, d).where(F.col("tenant_id").isin("1-URGENT", "2-HIGH")),
                           None, "2024-06-02 12:00:00", "INCREMENTAL")
    return a.unionByName(b)
