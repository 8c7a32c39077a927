"""Registered queries: each operator bound to inputs derived from the given
tables.  Every callable takes ``(spark, sf_dir)`` and returns a DataFrame.
Sinks and pipelines write under the shared checkpoint folder and return
what they wrote, read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from .functions import casting as C
from .functions.hashing import with_row_hash
from .functions.timeutil import ts_lit
from .functions.types import map_types
from .operators import merge as M
from .operators import metrics as A
from .operators import transform as P
from .plans import control as CT
from .plans import pipeline as PL
from .session import configure, scratch_path
from .sinks import writers as W
from .sources import catalog as CAT
from .sources import scans as S
from .sources import state as ST
from .streaming.upsert import stream_upsert

Q = Callable[[SparkSession, str], DataFrame]
_REG: dict[str, Q] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, d: str) -> DataFrame:
            configure(spark)
            return fn(spark, d)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REG[name] = run
        return run
    return deco


def registry() -> dict[str, Q]:
    from . import queries_more  # noqa: F401 - registers its own
    return dict(_REG)


# ====================================================================== scans
@query("full_scan")
def _full_scan(spark, d):
    """SC-01"""
    return S.full_scan(X.fo(spark, d))


@query("incremental_window")
def _incremental_window(spark, d):
    """SC-02: (last - 10 min, now] on a datetime column."""
    return S.incremental_window(X.fe(spark, d), "ts", X.EVENTS_LAST, X.EVENTS_NOW, 10)


@query("incremental_window_epoch")
def _incremental_window_epoch(spark, d):
    """SC-03: same window on an epoch-seconds column."""
    return S.incremental_window_epoch(X.fe(spark, d), "event_time", X.EVENTS_LAST, X.EVENTS_NOW, 10)


def _events_history(spark, d):
    return X.events_target(spark, d).where(F.col("tenant_id") != "shop3")


@query("lookback_scan")
def _lookback_scan(spark, d):
    """SC-04: per tenant, rows after (newest in target - 1 h)."""
    return S.lookback_scan(X.fe(spark, d), _events_history(spark, d), "ts", 1)


@query("lookback_scan_epoch")
def _lookback_scan_epoch(spark, d):
    return S.lookback_scan_epoch(X.fe(spark, d), _events_history(spark, d), "event_time", 1)


@query("bootstrap_recent")
def _bootstrap_recent(spark, d):
    """SC-05"""
    return S.bootstrap_recent(X.fe(spark, d), "ts", X.EVENTS_BOOTSTRAP_NOW, 24)


@query("since_last_load")
def _since_last_load(spark, d):
    """SC-06: rows newer than the target's last load time."""
    target = P.add_system_columns(X.target_orders(spark, d), None, "1997-06-01 00:00:00", "FULL")
    return S.since_last_load(X.fo(spark, d), target, "o_orderdate")


@query("incremental_projected")
def _incremental_projected(spark, d):
    """SC-07"""
    return S.incremental_projected(
        X.fo(spark, d), "o_orderdate",
        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "tenant_id"],
        X.ORDERS_LAST, X.ORDERS_NOW, 10)


@query("incremental_created_only")
def _incremental_created_only(spark, d):
    """SC-08"""
    return S.incremental_created_only(X.fo(spark, d), "o_orderdate", X.ORDERS_LAST)


TIER_SINCE = "2024-01-14 00:00:00"
TIER_HIGH, TIER_MEDIUM = 3.0, 2.75


@query("incremental_tiered_lookback")
def _incremental_tiered_lookback(spark, d):
    """SC-09: lookback per event type from its change rate."""
    e = X.fe(spark, d)
    policy = S.lookback_policy(e, "ts", "event_type", TIER_SINCE, X.EVENTS_LAST,
                               TIER_HIGH, TIER_MEDIUM)
    return S.incremental_tiered_lookback(e, "ts", policy, "event_type", X.EVENTS_LAST, X.EVENTS_NOW)


@query("paged_scan")
def _paged_scan(spark, d):
    """SC-10: all pages of the increment, numbered."""
    inc = S.incremental_window(X.fe(spark, d), "ts", X.EVENTS_LAST, X.EVENTS_NOW, 10)
    return S.paged_scan(inc, "ts", "event_id", 500)


@query("range_backfill")
def _range_backfill(spark, d):
    """SC-11"""
    return S.range_backfill(X.fo(spark, d), "o_orderdate", "1997-01-01", "1998-01-01")


KEYSET_TS, KEYSET_ID = "2024-01-20 00:00:00", 5000


@query("keyset_scan")
def _keyset_scan(spark, d):
    """SC-12"""
    return S.keyset_scan(X.fe(spark, d), "ts", "event_id", KEYSET_TS, KEYSET_ID)


@query("catalog_candidates")
def _catalog_candidates(spark, d):
    """SC-13"""
    return CAT.catalog_candidates(X.catalog(spark, d))


@query("status_scan")
def _status_scan(spark, d):
    """SC-14: per-tenant JSON documents written, then scanned back."""
    path = scratch_path(spark, "state")
    ST.write_status_documents(ST.tenant_documents(X.current_by_nation(spark, d), X.RUN_TIME), path)
    return ST.status_scan(spark, path)


def _legacy_rows(spark, d):
    cur = X.current_by_nation(spark, d)
    return cur.select(
        "tenant_id",
        F.when(F.col("table_name") == "order_status_log", F.lit(None)).otherwise(F.col("table_name"))
        .alias("table_name_v"),
        "table_name", "last_sync_time", "sync_status",
        F.when(F.col("table_name") == "logs", F.lit(None)).otherwise(F.col("sync_mode")).alias("sync_mode"),
        F.when(F.col("table_name") == "users", F.lit(None)).otherwise(F.col("records_synced"))
        .alias("records_synced"),
        "error_message", "updated_at")


def _write_legacy(spark, d) -> str:
    path = scratch_path(spark, "legacy-state")
    rows = _legacy_rows(spark, d)
    # the file name carries the table; the record may lack ``table_name``
    named = rows.withColumn("state_file", F.concat(
        F.concat_ws("_", "tenant_id", "table_name"), F.lit(".json")))
    (named.select("state_file", F.col("table_name_v").alias("table_name"), "last_sync_time",
                  "sync_status", "sync_mode", "records_synced", "error_message", "updated_at")
     .repartition("state_file").write.mode("overwrite").partitionBy("state_file").json(path))
    return path


@query("legacy_status_scan")
def _legacy_status_scan(spark, d):
    """SC-15"""
    return ST.legacy_status_scan(spark, _write_legacy(spark, d))


# ====================================================================== sinks
@query("write_truncate")
def _write_truncate(spark, d):
    """SK-01"""
    path = scratch_path(spark, "truncate")
    W.write_truncate(X.fo_changed(spark, d), path, ("tenant_id",))
    W.write_truncate(X.fo(spark, d), path, ("tenant_id",))
    return spark.read.parquet(path)


@query("write_append")
def _write_append(spark, d):
    """SK-02"""
    path = scratch_path(spark, "append")
    W.write_append(X.fo(spark, d), path, ("tenant_id",))
    W.write_append(X.source_orders(spark, d), path, ("tenant_id",))
    return spark.read.parquet(path)


@query("write_if_empty")
def _write_if_empty(spark, d):
    """SK-03: first write succeeds, the second is refused."""
    path = scratch_path(spark, "empty")
    W.ensure_target(spark, path, X.fo(spark, d).schema, ("tenant_id",))
    W.write_if_empty(X.fo(spark, d), path, ("tenant_id",))
    try:
        W.write_if_empty(X.source_orders(spark, d), path, ("tenant_id",))
        raise AssertionError("write_if_empty accepted a non-empty target")
    except W.TargetNotEmpty:
        pass
    return spark.read.parquet(path)


@query("partitioned_roundtrip")
def _partitioned_roundtrip(spark, d):
    """SK-04: append-only target by (sync_date, tenant_id)."""
    path = scratch_path(spark, "partitioned")
    df = W.with_sync_date(P.add_system_columns(X.fo(spark, d), None, X.RUN_TIME, "FULL"))
    W.ensure_target(spark, path, df.schema, ("sync_date", "tenant_id"))
    W.write_append(df, path, ("sync_date", "tenant_id"), "o_orderdate")
    return spark.read.schema(df.schema).parquet(path)


@query("replace_tenant")
def _replace_tenant(spark, d):
    """SK-05: replace 1-URGENT, empty 5-LOW, keep the others."""
    path = scratch_path(spark, "replace")
    W.write_truncate(X.fo(spark, d), path, ("tenant_id",))
    src = X.source_orders(spark, d).where(F.col("tenant_id") == "1-URGENT")
    W.replace_tenant(src, path, tenants=["1-URGENT", "5-LOW"], sort_col="o_orderdate")
    return spark.read.parquet(path)


@query("rebuild_with_hash")
def _rebuild_with_hash(spark, d):
    """SK-07"""
    path = scratch_path(spark, "rebuild")
    W.write_truncate(X.fo(spark, d), path, ("tenant_id",))
    W.rebuild_with_hash(spark, path)
    return spark.read.parquet(path)


# ====================================================================== projections
@query("add_system_columns")
def _add_system_columns(spark, d):
    """PR-01"""
    return P.add_system_columns(X.table(spark, d, "orders"), F.col("o_orderpriority"),
                                X.RUN_TIME, "FULL")


@query("normalize_types")
def _normalize_types(spark, d):
    """PR-02"""
    return P.normalize_types(X.dirty_wide(spark, d), X.DIRTY_TYPES)


@query("empty_to_null")
def _empty_to_null(spark, d):
    """PR-03"""
    x = X.dirty(spark, d)
    return x.select("o_orderkey", "raw", C.empty_to_null(F.col("raw")).alias("raw_or_null"),
                    C.to_int64(F.col("raw")).alias("raw_int"))


@query("quarantine_bad_values")
def _quarantine_bad_values(spark, d):
    """PR-04: bad values in long form (key, column, raw text)."""
    q = P.quarantine_bad_values(X.dirty_wide(spark, d), X.DIRTY_TYPES)
    return P.bad_value_rows(q, ["o_orderkey"])


@query("align_to_target")
def _align_to_target(spark, d):
    """PR-06"""
    return P.align_to_target(X.fo(spark, d), X.narrow_target(spark, d))


@query("iso_timestamps")
def _iso_timestamps(spark, d):
    """PR-07"""
    return P.iso_timestamps(X.fe(spark, d).select("event_id", "ts", "value"))


@query("epoch_to_timestamp")
def _epoch_to_timestamp(spark, d):
    """PR-08"""
    e = X.fe(spark, d).select("event_id", "event_time")
    return e.withColumn("event_ts", C.epoch_to_timestamp(F.col("event_time")))


@query("to_boolean")
def _to_boolean(spark, d):
    """PR-09"""
    x = X.dirty(spark, d)
    return x.select("o_orderkey", "raw", C.to_boolean(F.col("raw")).alias("raw_bool"),
                    C.to_boolean(F.col("o_orderkey") % 3, x.schema["o_orderkey"].dataType)
                    .alias("key_mod3_bool"))


@query("row_hash")
def _row_hash(spark, d):
    """PR-10 (with NULL keys)"""
    return with_row_hash(X.fo_null(spark, d))


@query("map_types")
def _map_types(spark, d):
    """PR-13"""
    return map_types(X.catalog(spark, d))


# ====================================================================== merges
@query("merge_on_key")
def _merge_on_key(spark, d):
    """J-01"""
    return M.merge_on_key(X.target_orders(spark, d), X.source_orders(spark, d), ["o_orderkey"])


MIN_KEY_RANGES, ROWS_PER_RANGE = 8, 1_000_000


def _key_range_bucket(spark, d):
    """``floor(o_orderkey / width)`` with the width set from the key range
    and the number of rows (two scalars): a range holds about
    ROWS_PER_RANGE rows, whatever the size of the table."""
    mx, n = X.table(spark, d, "orders").agg(F.max("o_orderkey"), F.count("*")).first()
    ranges = max(MIN_KEY_RANGES, -(-n // ROWS_PER_RANGE))
    width = max(1, -(-int(mx or 1) // ranges))
    return F.floor(F.col("o_orderkey") / F.lit(width))


@query("merge_into_table")
def _merge_into_table(spark, d):
    """J-01 on a stored table partitioned by tenant and key range: only the
    touched (tenant, key range) partitions are read and rewritten."""
    path = scratch_path(spark, "merge-table")
    bucket = _key_range_bucket(spark, d)
    W.merge_into_table(X.target_orders(spark, d), path, ["o_orderkey"], bucket=bucket)
    W.merge_into_table(X.source_orders(spark, d), path, ["o_orderkey"], bucket=bucket)
    return spark.read.parquet(path)


@query("merge_into_table_nulls")
def _merge_into_table_nulls(spark, d):
    """J-01 on a bucketed table, rows without key on both sides: a NULL matches
    nothing, so old and new rows both stay."""
    path = scratch_path(spark, "merge-nulls")
    bucket = F.pmod(F.col("o_orderkey"), F.lit(16))
    first = X.fo_null(spark, d)
    W.merge_into_table(first, path, ["o_orderkey"], bucket=bucket)
    W.merge_into_table(first.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["o_orderkey"],
                       bucket=bucket)
    return spark.read.parquet(path)


@query("merge_on_key_duplicates")
def _merge_on_key_duplicates(spark, d):
    """J-01 with keys that the source repeats: the newest row of each is merged."""
    lines = X.fl(spark, d)
    return M.merge_on_key(lines, lines.withColumn("l_quantity", F.col("l_quantity") + 1), ["l_orderkey"],
                          latest_by="l_shipdate")


@query("merge_on_key_only")
def _merge_on_key_only(spark, d):
    """J-02: source rows carry another tenant label; the key alone matches."""
    src = X.source_orders(spark, d).withColumn("tenant_id", F.lit("single"))
    return M.merge_on_key_only(X.target_orders(spark, d), src, ["o_orderkey"])


def _hash_source_third(spark, d):
    """Unchanged rows of the last 30 days before the last sync onward."""
    f = X.fo(spark, d)
    return with_row_hash(S.incremental_window(f, "o_orderdate", X.ORDERS_LAST, X.ORDERS_NOW,
                                              X.ORDERS_LOOKBACK_MIN))


@query("merge_on_hash")
def _merge_on_hash(spark, d):
    """J-03"""
    return M.merge_on_hash(X.hashed_target(spark, d), _hash_source_third(spark, d))


def _events_changed(spark, d):
    e = X.fe(spark, d).where(F.col("ts") > ts_lit("2024-01-19 00:00:00"))
    return e.withColumn("value", F.col("value") + 1)


@query("merge_on_timestamp")
def _merge_on_timestamp(spark, d):
    """J-04: key (event_time, tenant); colliding source rows reduced."""
    return M.merge_on_timestamp(X.events_target(spark, d), _events_changed(spark, d), "event_time")


@query("merge_shared_columns")
def _merge_shared_columns(spark, d):
    """J-05"""
    return M.merge_shared_columns(X.narrow_target(spark, d), X.source_orders(spark, d), ["o_orderkey"])


@query("append_new_by_hash")
def _append_new_by_hash(spark, d):
    """J-06"""
    return M.append_new_by_hash(X.hashed_target(spark, d), X.hashed_source(spark, d))


@query("already_present_rows")
def _already_present_rows(spark, d):
    """J-07"""
    return M.already_present_rows(X.hashed_target(spark, d), X.hashed_source(spark, d))


@query("append_blind")
def _append_blind(spark, d):
    """J-08"""
    return M.append_blind(X.fo(spark, d), X.source_orders(spark, d))


@query("latest_per_key")
def _latest_per_key(spark, d):
    """W-05 on lineitem (duplicate keys)."""
    return M.latest_per_key(X.fl(spark, d), ["l_orderkey", "l_linenumber", "tenant_id"], "l_shipdate")


@query("union_tenants")
def _union_tenants(spark, d):
    """U-01: one source per tenant, unioned and tagged."""
    o = X.table(spark, d, "orders")
    tenants = sorted(r[0] for r in o.select("o_orderpriority").distinct().collect())
    return PL.union_tenants({t: o.where(F.col("o_orderpriority") == t) for t in tenants})


# ====================================================================== aggregates
@query("last_load_time")
def _last_load_time(spark, d):
    """A-01"""
    return A.last_load_time(X.loaded_orders(spark, d))


@query("last_data_timestamp")
def _last_data_timestamp(spark, d):
    """A-02 (datetime column)"""
    return A.last_data_timestamp(X.fe(spark, d), "ts")


@query("last_data_timestamp_epoch")
def _last_data_timestamp_epoch(spark, d):
    """A-02 (epoch column)"""
    return A.last_data_timestamp(X.fe(spark, d), "event_time")


@query("rows_per_tenant")
def _rows_per_tenant(spark, d):
    """A-03"""
    return A.rows_per_tenant(X.fo(spark, d))


@query("existing_hashes")
def _existing_hashes(spark, d):
    """A-04"""
    return M.existing_hashes(X.hashed_source(spark, d))


@query("load_verification")
def _load_verification(spark, d):
    """A-05"""
    t = P.add_system_columns(X.hashed_source(spark, d), None, X.RUN_TIME, "FULL")
    return A.load_verification(t)


@query("conversion_stats")
def _conversion_stats(spark, d):
    """A-06"""
    return P.conversion_stats(X.dirty_wide(spark, d), X.DIRTY_TYPES)


@query("run_report")
def _run_report(spark, d):
    """A-07"""
    return A.run_report(X.run_stats(spark, d))


@query("database_subtotals")
def _database_subtotals(spark, d):
    """A-08"""
    return A.database_subtotals(X.run_stats(spark, d))


@query("tenant_summary")
def _tenant_summary(spark, d):
    """A-09 (table list shown as text)"""
    s = CT.tenant_summary(X.current(spark, d))
    return s.select("tenant_id", "total_tables", "last_updated",
                    F.array_join(F.transform("tables", lambda t: t["table_name"]), ",").alias("tables"))


@query("sync_overview")
def _sync_overview(spark, d):
    """A-10"""
    return CT.sync_overview(X.current(spark, d))


@query("change_volume")
def _change_volume(spark, d):
    """A-11"""
    return A.change_volume(X.fe(spark, d), "ts", "2024-01-20 00:00:00")


@query("changes_per_hour")
def _changes_per_hour(spark, d):
    """A-12"""
    return A.changes_per_hour(X.fe(spark, d), "ts", "2024-01-28 00:00:00")


@query("append_outcome")
def _append_outcome(spark, d):
    """A-13"""
    return A.append_outcome(X.hashed_target(spark, d), X.hashed_source(spark, d))


@query("key_columns")
def _key_columns(spark, d):
    """A-14 (key list shown as text)"""
    k = CAT.key_columns(X.catalog(spark, d))
    return k.select("tenant_id", "table_name", F.array_join("key_columns", ",").alias("key_columns"))


@query("migrate_status")
def _migrate_status(spark, d):
    """A-15"""
    legacy = ST.legacy_status_scan(spark, _write_legacy(spark, d))
    return CT.migrate_status(legacy, "2025-01-01T00:00:00")


def _reconcile_inputs(spark, d):
    f = X.fo(spark, d)
    # source: open orders changed price; target: loaded up to 2000-01-01, and
    # rows after 2000-06-01 stored under another key (extra + missing)
    src = f.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1)
                       .otherwise(F.col("o_totalprice")))
    keep = f.where(F.col("o_orderdate") <= ts_lit("2000-01-01 00:00:00"))
    extra = (f.where(F.col("o_orderdate") > ts_lit("2000-06-01 00:00:00"))
             .withColumn("o_orderkey", F.col("o_orderkey") + 100000000))
    return src, keep.unionByName(extra)


@query("reconcile")
def _reconcile(spark, d):
    """A-16"""
    src, tgt = _reconcile_inputs(spark, d)
    return A.reconcile(src, tgt, ["o_orderkey"])


# ====================================================================== rankings
@query("watermark_column")
def _watermark_column(spark, d):
    """W-01"""
    return CAT.watermark_column(X.catalog(spark, d))


@query("watermark_column_legacy")
def _watermark_column_legacy(spark, d):
    """W-02"""
    return CAT.watermark_column_legacy(X.catalog(spark, d))


@query("watermark_column_exact")
def _watermark_column_exact(spark, d):
    """W-03"""
    return CAT.watermark_column_exact(X.catalog(spark, d))


@query("recent_tables")
def _recent_tables(spark, d):
    """W-04"""
    return CT.recent_tables(X.current(spark, d), 3)


# ====================================================================== sorts
@query("ordered_increment")
def _ordered_increment(spark, d):
    """S-01"""
    inc = S.incremental_window(X.fe(spark, d), "ts", X.EVENTS_LAST, X.EVENTS_NOW, 10)
    return S.ordered_increment(inc, "ts", "event_id")


@query("capped_increment")
def _capped_increment(spark, d):
    """S-03: the first 1000 changes (the guide's batch cap)."""
    inc = S.incremental_window(X.fe(spark, d), "ts", X.EVENTS_LAST, X.EVENTS_NOW, 10)
    return S.capped_increment(inc, "ts", "event_id", 1000)


# ====================================================================== control
@query("last_sync_time")
def _last_sync_time(spark, d):
    """C-01"""
    return CT.last_sync_time(X.history(spark, d))


def _status_updates(spark, d):
    o = X.table(spark, d, "orders").where(F.col("o_orderdate") >= ts_lit("2001-01-01 00:00:00"))
    per = (o.groupBy(F.concat(F.lit("shop"), F.col("o_custkey").cast("string")).alias("tenant_id"),
                     X._priority_table().alias("table_name"))
           .agg(F.count(F.lit(1)).alias("records_synced"))
           .withColumn("status", F.lit("SUCCESS")).withColumn("sync_mode", F.lit("INCREMENTAL")))
    return CT.status_record(per, X.RUN_TIME, error_col=None)


@query("upsert_status")
def _upsert_status(spark, d):
    """C-02"""
    return CT.upsert_status(X.current(spark, d), _status_updates(spark, d))


def _facts(spark, d):
    return CAT.table_facts(X.catalog(spark, d))


@query("sync_plan")
def _sync_plan(spark, d):
    """C-03/C-04"""
    p = CT.sync_plan(_facts(spark, d), X.history(spark, d))
    return p.withColumn("key_columns", F.array_join("key_columns", ","))


@query("sync_plan_legacy")
def _sync_plan_legacy(spark, d):
    """C-05"""
    p = CT.sync_plan_legacy(_facts(spark, d))
    return p.withColumn("key_columns", F.array_join("key_columns", ","))


@query("safe_start")
def _safe_start(spark, d):
    """C-06"""
    return CT.safe_start(CT.last_sync_time(X.history(spark, d)), 10)


# ====================================================================== pipelines
def _tenants(df):
    return df.select("tenant_id").distinct()


@query("sync_table_full")
def _sync_table_full(spark, d):
    """P-01, first run: FULL for every tenant."""
    path = scratch_path(spark, "sync-full")
    src = X.fo(spark, d)
    PL.sync_table(src, path, "orders", PL.full_plan(_tenants(src)), X.RUN_TIME,
                  "o_orderdate", ["o_orderkey"])
    return spark.read.parquet(path)


@query("sync_table_incremental")
def _sync_table_incremental(spark, d):
    """P-01: FULL at the last sync, then INCREMENTAL with a 30-day lookback."""
    path = scratch_path(spark, "sync-incr")
    first = X.target_orders(spark, d)
    PL.sync_table(first, path, "orders", PL.full_plan(_tenants(first)), X.ORDERS_LAST,
                  "o_orderdate", ["o_orderkey"])
    wm = _tenants(first).withColumn("last_sync_time", ts_lit(X.ORDERS_LAST))
    PL.sync_table(X.fo_changed(spark, d), path, "orders",
                  PL.incremental_plan(wm, X.ORDERS_LOOKBACK_MIN), X.ORDERS_NOW,
                  "o_orderdate", ["o_orderkey"])
    return spark.read.parquet(path)


@query("sync_table_bucketed")
def _sync_table_bucketed(spark, d):
    """P-01 on a target partitioned by tenant and key range: the incremental
    run reads and rewrites only the touched (tenant, key range) partitions."""
    path = scratch_path(spark, "sync-bucket")
    bucket = _key_range_bucket(spark, d)
    first = X.target_orders(spark, d)
    PL.sync_table(first, path, "orders", PL.full_plan(_tenants(first)), X.ORDERS_LAST,
                  "o_orderdate", ["o_orderkey"], bucket=bucket)
    wm = _tenants(first).withColumn("last_sync_time", ts_lit(X.ORDERS_LAST))
    PL.sync_table(X.fo_changed(spark, d), path, "orders",
                  PL.incremental_plan(wm, X.ORDERS_LOOKBACK_MIN), X.ORDERS_NOW,
                  "o_orderdate", ["o_orderkey"], bucket=bucket)
    return spark.read.parquet(path)


@query("sync_all_report")
def _sync_all_report(spark, d):
    """P-02: two tables (keyed orders, key-less events) for all tenants."""
    o, e = X.fo(spark, d), X.fe(spark, d)
    tables = {
        "orders": dict(source=o, target_path=scratch_path(spark, "all-orders"),
                       plan=PL.full_plan(_tenants(o)), watermark="o_orderdate", keys=["o_orderkey"]),
        "events": dict(source=e, target_path=scratch_path(spark, "all-events"),
                       plan=PL.full_plan(_tenants(e)), watermark="ts", keys=[]),
    }
    stats, _records = PL.sync_all(tables, X.RUN_TIME, parallel=2)
    return stats.drop("error_message", "started_at", "duration_sec")


@query("smart_sync")
def _smart_sync(spark, d):
    """P-02 end to end, twice: the first run finds no history (FULL for
    every tenant), the second continues from the recorded successful sync
    (INCREMENTAL, 10-minute lookback, merge on the key)."""
    root = scratch_path(spark, "smart")
    keys = {"orders": ["o_orderkey"]}
    _s1, rec1 = PL.smart_sync({"orders": X.target_orders(spark, d)}, root, X.ORDERS_LAST, keys=keys)
    history = W.stage(rec1, "history")
    _s2, _rec2 = PL.smart_sync({"orders": X.fo_changed(spark, d)}, root, X.ORDERS_NOW,
                               history=history, keys=keys)
    return spark.read.parquet(f"{root}/orders")


@query("multitenant_load")
def _multitenant_load(spark, d):
    """P-03"""
    o = X.table(spark, d, "orders")
    tenants = sorted(r[0] for r in o.select("o_orderpriority").distinct().collect())
    frames = {t: o.where(F.col("o_orderpriority") == t) for t in tenants}
    return PL.multitenant_load(frames, scratch_path(spark, "mt"), X.RUN_TIME, "TRUNCATE")


@query("safe_append")
def _safe_append(spark, d):
    """P-04"""
    path = scratch_path(spark, "safe")
    loaded = X.target_orders(spark, d)
    first = with_row_hash(P.add_system_columns(loaded, None, X.RUN_TIME, "FULL"))
    W.write_append(first, path, ("tenant_id",))
    return PL.safe_append(X.fo(spark, d), path, X.RUN_TIME)


@query("safe_append_rebuilt")
def _safe_append_rebuilt(spark, d):
    """P-04 on a target loaded without hashes (SK-07 adds them): nothing is new."""
    path = scratch_path(spark, "safe-rebuilt")
    W.write_truncate(X.fo(spark, d), path, ("tenant_id",))
    return PL.safe_append(X.fo(spark, d), path, X.RUN_TIME)


@query("sync_table_keyless")
def _sync_table_keyless(spark, d):
    """P-01 without key: FULL, then an INCREMENTAL window that overlaps it by
    the lookback; only rows that are not there yet are added."""
    path = scratch_path(spark, "keyless")
    first = X.target_orders(spark, d)
    PL.sync_table(first, path, "orders", PL.full_plan(_tenants(first)), X.ORDERS_LAST, "o_orderdate")
    wm = _tenants(first).withColumn("last_sync_time", F.lit(X.ORDERS_LAST).cast("timestamp_ntz"))
    PL.sync_table(X.fo(spark, d), path, "orders", PL.incremental_plan(wm, X.ORDERS_LOOKBACK_MIN),
                  X.ORDERS_NOW, "o_orderdate")
    return spark.read.parquet(path)


@query("dedup_merge")
def _dedup_merge(spark, d):
    """P-05"""
    path = scratch_path(spark, "dedup")
    first = with_row_hash(P.add_system_columns(X.target_orders(spark, d), None, X.ORDERS_LAST, "FULL"))
    W.write_truncate(first, path, ("tenant_id",))
    PL.dedup_merge(X.fo_changed(spark, d), path, X.RUN_TIME, "o_orderdate", ["o_orderkey"])
    return spark.read.parquet(path)


LEGACY_NOW = "2024-01-31 00:00:00"


@query("legacy_incremental")
def _legacy_incremental(spark, d):
    """P-06: shop1/shop2 have history (lookback 1 h); shop3 bootstraps 24 h."""
    path = scratch_path(spark, "legacy")
    first = P.add_system_columns(_events_history(spark, d), None, X.EVENTS_TARGET_END, "FULL")
    W.write_truncate(first, path, ("tenant_id",))
    src = X.fe(spark, d).withColumn("value", F.col("value") + 1)
    PL.legacy_incremental(src, path, LEGACY_NOW, "ts", 1, 24)
    return spark.read.parquet(path)


# ====================================================================== streaming
STREAM_CHUNKS = [(None, "2024-01-11 00:00:00"), ("2024-01-10 00:00:00", "2024-01-21 00:00:00"),
                 ("2024-01-20 00:00:00", None)]


@query("stream_upsert")
def _stream_upsert(spark, d):
    """ST-01: three overlapping increments streamed and merged on key."""
    inp, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    e = X.fe(spark, d)
    schema = None
    for i, (lo, hi) in enumerate(STREAM_CHUNKS):
        c = e
        if lo:
            c = c.where(F.col("ts") > ts_lit(lo))
        if hi:
            c = c.where(F.col("ts") <= ts_lit(hi))
        if i == len(STREAM_CHUNKS) - 1:
            c = c.withColumn("value", F.col("value") + 1)
        # extraction time of the increment: the newest delivery of a key wins
        c = c.withColumn("sync_timestamp", ts_lit(hi or X.RUN_TIME))
        schema = c.schema
        c.write.mode("append").parquet(inp)
    stream_upsert(spark, inp, schema, out, ["event_id"], latest_by="sync_timestamp",
                  files_per_batch=2)
    return spark.read.parquet(out)


# ====================================================================== scalar functions
@query("scalar_functions")
def _scalar_functions(spark, d):
    """§2.9 in one projection over events."""
    e = X.fe(spark, d)
    return e.select(
        "event_id",
        F.md5(F.col("props")).alias("props_md5"),
        F.coalesce(F.col("props"), F.lit("NULL")).alias("props_or_null"),
        C.timestamp_to_epoch(F.col("ts")).alias("epoch"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("hour_text"),
        F.to_date("ts").alias("ts_date"),
        (F.col("ts") - F.make_dt_interval(hours=F.lit(1))).alias("ts_minus_hour"),
        F.lower(F.col("event_type")).startswith("c").alias("starts_c"),
        F.col("props").rlike("(7|9)").alias("has_7_or_9"),
        F.substring_index(F.col("props"), ":", 1).alias("before_colon"),
        F.substring(F.col("props"), 1, 5).alias("first5"),
        F.regexp_extract(F.col("tenant_id"), r"^([a-z]+)([0-9]+)$", 2).alias("tenant_no"),
        F.when(F.col("event_type").isin("click", "view"), F.lit(1)).otherwise(F.lit(5)).alias("rank5"),
        C.parse_timestamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("parsed"),
    )
