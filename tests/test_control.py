"""Control table, state documents, pipelines and the stream (SURVEY §5 (4)):
failure path, empty source, unparsable times, resumable stream."""

import json
import os

from pyspark.sql import functions as F

from tablesync import fixtures as X
from tablesync.plans import control as CT
from tablesync.plans import pipeline as PL
from tablesync.session import to_local
from tablesync.sources import state as ST
from tablesync.streaming.upsert import stream_upsert

from .conftest import SF_SMALL

HIST = ("tenant_id string, table_name string, last_sync_time string, sync_status string, "
        "sync_mode string, records_synced long, error_message string, updated_at string")


def _hist(spark, rows):
    return spark.createDataFrame(rows, HIST)


def test_failed_run_does_not_advance_watermark(spark):
    h = _hist(spark, [
        ("s1", "t", "2024-01-01T00:00:00", "SUCCESS", "FULL", 5, None, "2024-01-01T00:00:00"),
        ("s1", "t", "2024-01-02T00:00:00", "FAILED", "INCREMENTAL", 0, "boom", "2024-01-02T00:00:00"),
        ("s1", "u", "not-a-time", "SUCCESS", "FULL", 1, None, "2024-01-01T00:00:00"),
    ])
    got = {r.table_name: r.last_sync_time for r in CT.last_sync_time(h).collect()}
    assert str(got["t"]) == "2024-01-01 00:00:00"
    assert "u" not in got            # unparsable -> no watermark


def test_sync_plan_reasons(spark):
    facts = spark.createDataFrame(
        [("s1", "t", "updated_at", ["id"]), ("s1", "u", None, None), ("s1", "v", "ts", None),
         ("s2", "t", "updated_at", ["id"])],
        "tenant_id string, table_name string, watermark_column string, key_columns array<string>")
    h = _hist(spark, [
        ("s1", "t", "2024-01-01T00:00:00", "SUCCESS", "FULL", 5, None, "2024-01-01T00:00:00"),
        ("s1", "t", "2024-01-02T00:00:00", "FAILED", "INCREMENTAL", 0, "x", "2024-01-02T00:00:00"),
        ("s1", "u", "2024-01-01T00:00:00", "SUCCESS", "FULL", 5, None, "2024-01-01T00:00:00"),
        ("s1", "v", "2024-01-01T00:00:00", "SUCCESS", "FULL", 5, None, "2024-01-01T00:00:00"),
    ])
    plan = {(r.tenant_id, r.table_name): r for r in CT.sync_plan(facts, h).collect()}
    assert plan[("s1", "t")].sync_mode == "FULL" and plan[("s1", "t")].reason == "last run failed"
    assert plan[("s1", "u")].reason == "no timestamp column"
    assert plan[("s1", "v")].sync_mode == "INCREMENTAL"
    assert plan[("s1", "v")].write_strategy == "append_new_by_hash"
    assert str(plan[("s1", "v")].safe_start) == "2023-12-31 23:50:00"
    assert plan[("s2", "t")].reason == "first sync"
    forced = {r.table_name: r.reason for r in CT.sync_plan(facts, h, force_full=True).collect()}
    assert set(forced.values()) == {"forced"}


def test_status_documents_round_trip_and_bad_file(spark, tmp_table):
    path = tmp_table("state")
    cur = CT.current_status(X.history(spark, SF_SMALL))
    ST.write_status_documents(ST.tenant_documents(cur, "2025-01-01T00:00:00"), path)
    local = to_local(path)
    os.makedirs(os.path.join(local, "broken"), exist_ok=True)
    with open(os.path.join(local, "broken", "shopX.json"), "w") as fh:
        fh.write("{not json")
    back = ST.status_scan(spark, path)
    assert back.count() == cur.count()
    assert back.where("tenant_id = 'shopX'").count() == 0


def test_legacy_file_names(spark, tmp_table):
    path = to_local(tmp_table("legacy"))
    os.makedirs(path)
    with open(os.path.join(path, "shop7_order_items.json"), "w") as fh:
        json.dump({"table_name": "order_items", "last_sync_time": "2024-01-01T00:00:00"}, fh)
    with open(os.path.join(path, "shop7_junk.json"), "w") as fh:
        json.dump({"other": 1}, fh)
    rows = ST.legacy_status_scan(spark, path).collect()
    assert [(r.tenant_id, r.file_table) for r in rows] == [("shop7", "order_items")]
    mig = CT.migrate_status(ST.legacy_status_scan(spark, path), "2025-01-01T00:00:00").collect()[0]
    assert (mig.sync_status, mig.sync_mode, mig.records_synced, mig.total_tables) == \
        ("UNKNOWN", "UNKNOWN", 0, 1)


def test_full_then_incremental_equals_full_of_final(spark, tmp_table):
    """A full load then an incremental run equals one full load of the final
    source (rows do not change, only arrive), apart from the sync columns."""
    path = tmp_table("p1")
    first = X.target_orders(spark, SF_SMALL)
    PL.sync_table(first, path, "orders", PL.full_plan(first.select("tenant_id").distinct()),
                  X.ORDERS_LAST, "o_orderdate", ["o_orderkey"])
    final = X.fo(spark, SF_SMALL).where(F.col("o_orderdate") <= F.lit(X.ORDERS_NOW).cast("timestamp_ntz"))
    wm = first.select("tenant_id").distinct().withColumn(
        "last_sync_time", F.lit(X.ORDERS_LAST).cast("timestamp_ntz"))
    PL.sync_table(final, path, "orders", PL.incremental_plan(wm, 60), X.ORDERS_NOW,
                  "o_orderdate", ["o_orderkey"])
    got = spark.read.parquet(path).drop("sync_timestamp", "sync_mode")
    assert got.count() == final.count()
    assert got.select(*final.columns).exceptAll(final).count() == 0


def test_full_sync_with_empty_source_empties_tenant(spark, tmp_table):
    path = tmp_table("p2")
    f = X.fo(spark, SF_SMALL)
    PL.sync_table(f, path, "orders", PL.full_plan(f.select("tenant_id").distinct()), X.RUN_TIME,
                  "o_orderdate", ["o_orderkey"])
    empty = f.where("tenant_id = '3-MEDIUM'").limit(0)
    plan = PL.full_plan(spark.createDataFrame([("3-MEDIUM",)], "tenant_id string"))
    stats = PL.sync_table(empty, path, "orders", plan, X.RUN_TIME, "o_orderdate", ["o_orderkey"])
    assert stats.collect()[0].records_synced == 0
    after = spark.read.parquet(path)
    assert after.where("tenant_id = '3-MEDIUM'").count() == 0
    assert after.count() == f.where("tenant_id <> '3-MEDIUM'").count()


def test_stream_resumes_from_checkpoint(spark, tmp_table):
    inp, out, ckpt = tmp_table("sin"), tmp_table("sout"), tmp_table("sck")
    e = X.fe(spark, SF_SMALL).withColumn("sync_timestamp", F.lit(X.RUN_TIME).cast("timestamp_ntz"))
    e.where("ts <= TIMESTAMP_NTZ'2024-01-15 00:00:00'").write.parquet(inp, mode="append")
    stream_upsert(spark, inp, e.schema, out, ["event_id"], "sync_timestamp", ckpt)
    n1 = spark.read.parquet(out).count()
    # run again without new files: nothing is reprocessed
    stream_upsert(spark, inp, e.schema, out, ["event_id"], "sync_timestamp", ckpt)
    assert spark.read.parquet(out).count() == n1
    e.where("ts > TIMESTAMP_NTZ'2024-01-14 00:00:00'").write.parquet(inp, mode="append")
    stream_upsert(spark, inp, e.schema, out, ["event_id"], "sync_timestamp", ckpt)
    assert spark.read.parquet(out).count() == e.count()


def test_status_documents_as_json_lines(spark, tmp_table):
    path = tmp_table("state-lines")
    cur = CT.current_status(X.history(spark, SF_SMALL))
    ST.write_status_documents(ST.tenant_documents(cur), path, one_file_per_tenant=False, files=3)
    back = ST.status_scan(spark, path, multi_line=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cur.collect()))


def test_legacy_incremental_schema_tolerant(spark, tmp_table):
    """P-06 twin: the target lacks a source column and has its own column;
    the merge keeps the target's schema and its own column's values."""
    from tablesync.operators.transform import add_system_columns
    from tablesync.sinks import writers as W
    path = tmp_table("legacy-compat")
    e = X.fe(spark, SF_SMALL)
    first = add_system_columns(e.where("ts <= TIMESTAMP_NTZ'2024-01-20 00:00:00'"), None,
                               X.EVENTS_TARGET_END, "FULL").drop("props").withColumn("note", F.lit("keep"))
    W.write_truncate(first, path, ("tenant_id",))
    PL.legacy_incremental(e.withColumn("value", F.col("value") + 1), path, "2024-01-31 00:00:00", "ts",
                          1, 24, shared_columns=True, key="event_id")
    out = spark.read.parquet(path)
    assert "props" not in out.columns and "note" in out.columns
    assert out.where("note IS NULL").count() > 0            # inserted rows
    # matched rows took the source values but kept the target-only column
    assert out.where("note = 'keep' AND sync_mode = 'INCREMENTAL'").count() > 0
    assert out.where("sync_mode = 'FULL' AND note IS NULL").count() == 0
    assert out.groupBy("event_id", "tenant_id").count().where("count > 1").count() == 0


def test_stream_keeps_tenants_newest_and_late_rows(spark, tmp_table):
    """Rows delivered twice, a key in two tenants, an updated value, a late row."""
    inp, out = tmp_table("sdin"), tmp_table("sdout")

    def rows(*r):
        return spark.sql(" UNION ALL ".join(
            f"SELECT CAST({k} AS BIGINT) k, '{t}' tenant_id, CAST({v} AS DOUBLE) v, "
            f"TIMESTAMP_NTZ'{ts}' ts" for k, t, v, ts in r))
    rows((1, "a", 1.0, "2024-01-01 10:00:00"), (1, "b", 1.0, "2024-01-01 10:00:00"),
         (1, "a", 9.0, "2024-01-01 10:05:00"), (1, "a", 1.0, "2024-01-01 10:00:00")).write.parquet(inp)
    df = spark.read.parquet(inp)
    stream_upsert(spark, inp, df.schema, out, ["k"], "ts", files_per_batch=1000)
    got = sorted((r["k"], r["tenant_id"], r["v"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, "a", 9.0), (1, "b", 1.0)]


def test_bucketed_sync_table(spark, tmp_table):
    """P-01 with key buckets: same rows as the tenant-level pipeline; a FULL
    re-run with fewer rows leaves no stale bucket behind."""
    path, ref = tmp_table("p-bucket"), tmp_table("p-ref")
    bucket = F.floor(F.col("o_orderkey") / 100)
    first = X.target_orders(spark, SF_SMALL)
    tenants = first.select("tenant_id").distinct()
    wm = tenants.withColumn("last_sync_time", F.lit(X.ORDERS_LAST).cast("timestamp_ntz"))
    for p, b in ((path, bucket), (ref, None)):
        PL.sync_table(first, p, "orders", PL.full_plan(tenants), X.ORDERS_LAST, "o_orderdate",
                      ["o_orderkey"], bucket=b)
        PL.sync_table(X.fo_changed(spark, SF_SMALL), p, "orders",
                      PL.incremental_plan(wm, X.ORDERS_LOOKBACK_MIN), X.ORDERS_NOW, "o_orderdate",
                      ["o_orderkey"], bucket=b)
    got = spark.read.parquet(path).drop("key_bucket")
    want = spark.read.parquet(ref)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    # FULL again for one tenant with only its first 5 rows
    small = first.where("tenant_id = '1-URGENT'").orderBy("o_orderkey").limit(5)
    PL.sync_table(small, path, "orders", PL.full_plan(spark.createDataFrame([("1-URGENT",)], "tenant_id string")),
                  X.RUN_TIME, "o_orderdate", ["o_orderkey"], bucket=bucket)
    after = spark.read.parquet(path)
    assert after.where("tenant_id = '1-URGENT'").count() == 5
    assert after.where("tenant_id <> '1-URGENT'").count() == got.where("tenant_id <> '1-URGENT'").count()


def test_smart_sync_modes_follow_history(spark, tmp_table):
    root = tmp_table("smart")
    keys = {"orders": ["o_orderkey"]}
    s1, rec1 = PL.smart_sync({"orders": X.target_orders(spark, SF_SMALL)}, root, X.ORDERS_LAST, keys=keys)
    assert {r.sync_mode for r in s1.collect()} == {"FULL"}
    hist = spark.createDataFrame(rec1.collect(), rec1.schema)   # small control records
    s2, rec2 = PL.smart_sync({"orders": X.fo_changed(spark, SF_SMALL)}, root, X.ORDERS_NOW,
                             history=hist, keys=keys)
    assert {r.sync_mode for r in s2.collect()} == {"INCREMENTAL"}
    # a failed last run for one tenant forces FULL for it only
    failed = rec2.where("tenant_id = '1-URGENT'").withColumn("sync_status", F.lit("FAILED")) \
        .withColumn("updated_at", F.lit("1999-01-02T00:00:00"))
    hist3 = hist.unionByName(spark.createDataFrame(rec2.collect(), rec2.schema)).unionByName(failed)
    s3, _ = PL.smart_sync({"orders": X.fo_changed(spark, SF_SMALL)}, root, "1999-01-03 00:00:00",
                          history=hist3, keys=keys)
    modes = {r.tenant_id: r.sync_mode for r in s3.collect()}
    assert modes["1-URGENT"] == "FULL" and {m for t, m in modes.items() if t != "1-URGENT"} == {"INCREMENTAL"}


def test_smart_sync_with_control_table(spark, tmp_table):
    root, ctl = tmp_table("smart-ctl"), tmp_table("control")
    keys = {"orders": ["o_orderkey"]}
    PL.smart_sync({"orders": X.target_orders(spark, SF_SMALL)}, root, X.ORDERS_LAST, keys=keys,
                  control_path=ctl)
    s2, _ = PL.smart_sync({"orders": X.fo_changed(spark, SF_SMALL)}, root, X.ORDERS_NOW, keys=keys,
                          control_path=ctl)
    assert {r.sync_mode for r in s2.collect()} == {"INCREMENTAL"}
    cur = CT.current_status(spark.read.parquet(ctl)).collect()
    assert {r.sync_mode for r in cur} == {"INCREMENTAL"} and len(cur) == 5
