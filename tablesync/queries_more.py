"""Further registered queries: stored indexes, changing columns, lost and
failing tenants, control history, pages and types.  Bound like those of
:mod:`tablesync.queries`, whose registry they join."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as X
from . import queries as Q
from .functions.hashing import with_row_hash
from .functions.timeutil import ts_lit
from .operators import metrics as A
from .operators import transform as P
from .plans import control as CT
from .plans import pipeline as PL
from .queries import query
from .session import scratch_path
from .sinks import writers as W
from .sources import scans as S
from .sources import state as ST
from .streaming.upsert import stream_upsert_distinct

ALL_TYPES = {"o_orderkey": "bigint(20)", "v_date": "date", "v_time": "datetime", "v_flag": "boolean",
             "v_bytes": "blob"}
PAGE_NO, PAGE_SIZE = 1, 500


def _noted(df):
    return df.withColumn("note", F.concat(F.lit("n"), F.col("o_orderkey").cast("string")))


# ---------------------------------------------------------------- columns that come and go
@query("safe_append_new_column")
def _safe_append_new_column(spark, d):
    """P-04: the source has gained a column; unchanged rows are not new."""
    path = scratch_path(spark, "safe-gain")
    PL.safe_append(X.target_orders(spark, d), path, X.RUN_TIME)
    return PL.safe_append(_noted(X.fo(spark, d)), path, X.RUN_TIME)


@query("safe_append_lost_column")
def _safe_append_lost_column(spark, d):
    """P-04: the source has lost a column that the stored hash covers: both
    sides are compared over the columns they share."""
    path = scratch_path(spark, "safe-loss")
    PL.safe_append(_noted(X.target_orders(spark, d)), path, X.RUN_TIME)
    return PL.safe_append(X.fo(spark, d), path, X.RUN_TIME)


@query("sync_table_keyless_new_column")
def _sync_table_keyless_new_column(spark, d):
    """P-01 without key: FULL, then an overlapping window of a source that has
    gained a column; the overlap adds nothing."""
    path = scratch_path(spark, "keyless-gain")
    first = X.target_orders(spark, d)
    PL.sync_table(first, path, "orders", PL.full_plan(Q._tenants(first)), X.ORDERS_LAST, "o_orderdate")
    wm = Q._tenants(first).withColumn("last_sync_time", ts_lit(X.ORDERS_LAST))
    PL.sync_table(_noted(X.fo(spark, d)), path, "orders", PL.incremental_plan(wm, X.ORDERS_LOOKBACK_MIN),
                  X.ORDERS_NOW, "o_orderdate")
    return spark.read.parquet(path)


@query("safe_append_indexed")
def _safe_append_indexed(spark, d):
    """P-04 with the persistent hash index (J-06, U-02): the second append
    reads the index that the first one has kept."""
    path = scratch_path(spark, "safe-index")
    first = with_row_hash(P.add_system_columns(X.target_orders(spark, d), None, X.RUN_TIME, "FULL"))
    W.write_append(first, path, ("tenant_id",))
    until = X.fo(spark, d).where(F.col("o_orderdate") <= ts_lit(X.ORDERS_NOW))
    PL.safe_append(until, path, X.RUN_TIME, use_index=True)
    return PL.safe_append(X.fo(spark, d), path, X.RUN_TIME, use_index=True)


# ---------------------------------------------------------------- tenants
def _null_tenant(df):
    return df.withColumn("tenant_id", F.when(F.col("tenant_id") != "5-LOW", F.col("tenant_id")))


@query("sync_table_null_tenant")
def _sync_table_null_tenant(spark, d):
    """P-01 with rows of no tenant, and a tenant that has never been synced
    (its window starts in 1970)."""
    path = scratch_path(spark, "null-tenant")
    first = _null_tenant(X.target_orders(spark, d))
    PL.sync_table(first, path, "orders", PL.full_plan(Q._tenants(first)), X.ORDERS_LAST,
                  "o_orderdate", ["o_orderkey"])
    last = F.when(~F.col("tenant_id").eqNullSafe("1-URGENT"), ts_lit(X.ORDERS_LAST))
    wm = Q._tenants(first).withColumn("last_sync_time", last)
    PL.sync_table(_null_tenant(X.fo(spark, d)), path, "orders", PL.incremental_plan(wm, 0), X.ORDERS_NOW,
                  "o_orderdate", ["o_orderkey"])
    return spark.read.parquet(path)


@query("scan_tenants")
def _scan_tenants(spark, d):
    """U-01 in one scan over tenant folders."""
    path = scratch_path(spark, "tenant-folders")
    o = X.fo(spark, d)
    W.write_truncate(o, path, ("tenant_id",))
    return PL.scan_tenants(spark, path, o.schema)


@query("multitenant_load_failing")
def _multitenant_load_failing(spark, d):
    """P-03: one tenant's file is no Parquet file, another has no folder: both
    are reported, all others load, in one scan."""
    path = scratch_path(spark, "tenant-sources")
    o = X.fo(spark, d)
    W.write_truncate(o, path, ("tenant_id",))
    schema = o.drop("tenant_id").schema
    folders = {t: W._partition_path(spark, path, "tenant_id", t).toString() for t in W.touched_tenants(o)}
    fs, _ = W._fs(spark, path)
    for st in fs.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folders["3-MEDIUM"])):
        out = fs.create(st.getPath(), True)
        out.write(bytearray(b"no parquet file"))
        out.close()
    frames = {t: (lambda f=f: spark.read.schema(schema).parquet(f)) for t, f in folders.items()}
    frames["6-ABSENT"] = lambda: spark.read.schema(schema).parquet(path + "/absent")
    failed: dict[str, str] = {}
    loaded = PL.multitenant_load(frames, scratch_path(spark, "mt-failing"), X.RUN_TIME, "TRUNCATE", failed, 2)
    return PL.load_report(loaded, failed).drop("error_message")


@query("legacy_incremental_compatible")
def _legacy_incremental_compatible(spark, d):
    """P-06, schema-tolerant: the source lacks ``props`` and has a column of its
    own; the target keeps its columns and the props it has."""
    path = scratch_path(spark, "legacy-tolerant")
    first = P.add_system_columns(Q._events_history(spark, d), None, X.EVENTS_TARGET_END, "FULL")
    W.write_truncate(first, path, ("tenant_id",))
    src = X.fe(spark, d).withColumn("value", F.col("value") + 1).drop("props").withColumn("own", F.lit("x"))
    PL.legacy_incremental(src, path, Q.LEGACY_NOW, "ts", 1, 24, shared_columns=True, key="event_id")
    return spark.read.parquet(path)


# ---------------------------------------------------------------- types
@query("normalize_types_all")
def _normalize_types_all(spark, d):
    """PR-02 with DATE, TIMESTAMP and BYTES, a type that the map does not know
    (text), and PR-05: a column outside the known schema becomes text."""
    o = X.table(spark, d, "orders")
    k = F.col("o_orderkey") % 4
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = o.select(
        "o_orderkey", F.when(k == 0, F.lit("no date")).when(k != 1, day).alias("v_date"),
        F.when(k == 2, F.lit("12:99")).when(k != 3, F.concat(day, F.lit("T10:11:12"))).alias("v_time"),
        F.when(k == 0, F.lit("0")).when(k == 1, F.lit("7")).when(k == 2, F.lit("yes")).alias("v_flag"),
        F.when(k != 2, F.col("o_orderpriority")).alias("v_bytes"), F.col("o_custkey").alias("v_other"))
    out = P.normalize_types(raw, ALL_TYPES)
    return out.withColumn("v_bytes", F.hex("v_bytes"))


@query("smart_sync_dirty")
def _smart_sync_dirty(spark, d):
    """P-02 end to end over dirty columns: values are converted by the source's
    field types, what does not convert is kept aside."""
    root = scratch_path(spark, "smart-dirty")
    o = X.table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("tenant_id"))
    src = X.dirty_wide(spark, d).join(o, "o_orderkey")
    PL.smart_sync({"dirty": src}, root, X.RUN_TIME, keys={"dirty": ["o_orderkey"]},
                  field_types={"dirty": X.DIRTY_TYPES})
    rows = spark.read.parquet(f"{root}/dirty")
    bad = F.array_join(F.array_sort(F.map_keys("bad_values")), ",")
    return rows.select("o_orderkey", "tenant_id", "sync_mode", "v_int", "v_double", "v_decimal", "v_text",
                       bad.alias("bad_columns"))


# ---------------------------------------------------------------- reconciliation, metadata, pages
@query("reconcile_tree")
def _reconcile_tree(spark, d):
    """A-16 by a tree of digests."""
    src, tgt = Q._reconcile_inputs(spark, d)
    return A.reconcile_tree(src, tgt, ["o_orderkey"])


@query("newest_from_metadata")
def _newest_from_metadata(spark, d):
    """A-02 from Parquet footers."""
    path = scratch_path(spark, "footers")
    W.write_truncate(X.fe(spark, d), path, ("tenant_id",))
    return A.newest_from_metadata(spark, path, "event_time", "tenant_id")


@query("offset_page")
def _offset_page(spark, d):
    """S-04: one page by offset and limit."""
    return S.page(X.fe(spark, d), "ts", "event_id", PAGE_NO, PAGE_SIZE)


@query("page_bounds")
def _page_bounds(spark, d):
    """SC-10: where each page of the increment begins, by a quantile sketch."""
    inc = S.incremental_window(X.fe(spark, d), "ts", X.EVENTS_LAST, X.EVENTS_NOW, 10)
    return S.page_bounds(inc, "ts", "event_id", 1000)


# ---------------------------------------------------------------- control
@query("sync_plan_control_table")
def _sync_plan_control_table(spark, d):
    """C-01..C-04 from the control table: the history comes in runs, which are
    folded into a snapshot; the plan is that of the whole history."""
    control = CT.ControlTable(spark, scratch_path(spark, "control"), log_runs=2)
    history = X.history(spark, d)
    part = F.pmod(F.xxhash64("tenant_id", "updated_at"), F.lit(3))
    for i in range(3):
        control.append(history.where(part == i))
    p = CT.sync_plan(Q._facts(spark, d), CT.ControlTable(spark, control.path).read())
    return p.withColumn("key_columns", F.array_join("key_columns", ","))


@query("migrate_status_documents")
def _migrate_status_documents(spark, d):
    """A-15: the per-tenant documents of the new layout."""
    legacy = ST.legacy_status_scan(spark, Q._write_legacy(spark, d))
    return CT.tenant_documents(CT.migrate_status(legacy, "2025-01-01T00:00:00"), "2025-01-01T00:00:00")


# ---------------------------------------------------------------- streaming
@query("stream_upsert_distinct")
def _stream_upsert_distinct(spark, d):
    """ST-01 with repeated deliveries: every increment arrives twice and
    overlaps the one before by a day, more than the watermark's hour."""
    inp, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    e = X.fe(spark, d)
    schema = None
    for lo, hi in Q.STREAM_CHUNKS:
        c = e
        if lo:
            c = c.where(F.col("ts") > ts_lit(lo))
        if hi:
            c = c.where(F.col("ts") <= ts_lit(hi))
        if hi is None:
            c = c.withColumn("value", F.col("value") + 1)
        c = c.withColumn("sync_timestamp", ts_lit(hi or X.RUN_TIME))
        schema = c.schema
        for _ in range(2):
            c.write.mode("append").parquet(inp)
    stream_upsert_distinct(spark, inp, schema, out, ["event_id"], "ts", "sync_timestamp", "1 hour",
                           files_per_batch=2)
    return spark.read.parquet(out)
