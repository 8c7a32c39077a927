"""Rows that earlier versions lost, repeated or misjudged."""

import pytest
from pyspark.sql import functions as F

from tablesync.functions import casting as C
from tablesync.functions.hashing import with_row_hash
from tablesync.operators import merge as M
from tablesync.operators import metrics as A
from tablesync.operators.transform import add_system_columns
from tablesync.plans import pipeline as PL
from tablesync.sinks import writers as W

T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def _frame(spark, rows, keys="id long"):
    """(id, tenant, value) rows with a fixed time of change."""
    df = spark.createDataFrame(rows, f"{keys}, tenant_id string, v double")
    return df.withColumn("updated_at", F.lit("2023-12-31 23:59:00").cast("timestamp_ntz"))


def _plan(spark, tenants, mode):
    p = PL.full_plan(spark.createDataFrame([(t,) for t in tenants], "tenant_id string"))
    if mode == "INCREMENTAL":
        p = p.withColumn("sync_mode", F.lit(mode)).withColumn("safe_start", F.lit("2023-12-31 23:00:00").cast("timestamp_ntz"))
    return p


def _read(spark, path):
    return sorted((r["id"] is None, r["id"], r["tenant_id"] or "", r["v"]) for r in spark.read.parquet(path).collect())


def test_hash_is_exact(spark):
    vals = [0.12345671, 0.12345674, None, float("nan"), 1e33, float("inf"), float("-inf"), 0.0, 5e-324, 1.5, -1.5, 2.0, 3.0, 1e308]
    rows = with_row_hash(spark.createDataFrame([(v,) for v in vals], "v double")).collect()
    assert len({r["data_hash"] for r in rows}) == len(vals)
    texts = [("NULL", "x"), (None, "x"), ("1\x1fb=2", "3"), ("1", "2\x1fb=3"), ("N", "x")]
    rows = with_row_hash(spark.createDataFrame(texts, "a string, b string")).collect()
    assert len({r["data_hash"] for r in rows}) == len(texts)


def test_keyless_incremental_adds_only_new_rows(spark, tmp_table):
    path = tmp_table("keyless")
    src = _frame(spark, [(1, "a", 1.0), (2, "a", 2.0)])
    PL.sync_table(src, path, "t", _plan(spark, ["a"], "FULL"), T0, "updated_at")
    more = src.unionByName(_frame(spark, [(3, "a", 3.0)]))
    PL.sync_table(more, path, "t", _plan(spark, ["a"], "INCREMENTAL"), T1, "updated_at")
    assert [r[1] for r in _read(spark, path)] == [1, 2, 3]


def test_safe_append_on_a_rebuilt_target_adds_nothing(spark, tmp_table):
    path = tmp_table("rebuilt")
    src = _frame(spark, [(1, "a", 1.0), (2, None, 2.0)])
    W.write_truncate(src, path, ("tenant_id",))
    out = {(r["tenant_id"], r["is_total"]): r for r in PL.safe_append(src, path, T1).collect()}
    assert out[(None, True)]["new_rows"] == 0 and out[(None, False)]["duplicate_rows"] == 1
    assert spark.read.parquet(path).count() == 2


def test_keyless_dedup_merge_on_a_full_load(spark, tmp_table):
    path = tmp_table("dedup-full")
    src = _frame(spark, [(1, "a", 1.0), (2, "a", 2.0)])
    PL.sync_table(src, path, "t", _plan(spark, ["a"], "FULL"), T0, "updated_at")
    PL.dedup_merge(src, path, T1, None)
    assert spark.read.parquet(path).count() == 2


def test_bucketed_full_twice_keeps_null_and_odd_buckets(spark, tmp_table):
    src = _frame(spark, [(1, "a", 1.0), (None, "a", 2.0), (3, "a:b", 3.0)])
    for bucket in (F.col("id") % 2, F.concat(F.lit("x:/"), F.col("id"))):
        path = tmp_table("bucketed")
        for _ in range(2):
            PL.sync_table(src, path, "t", _plan(spark, ["a", "a:b"], "FULL"), T0, "updated_at", ["id"], bucket=bucket)
        assert len(_read(spark, path)) == 3


@pytest.mark.parametrize("bucket", [None, "id"])
def test_merge_into_table_keeps_null_keys_and_tenants(spark, tmp_table, bucket):
    path = tmp_table("nulls")
    b = F.col(bucket) if bucket else None
    W.merge_into_table(_frame(spark, [(1, "a", 1.0), (None, "a", 2.0), (5, None, 5.0)]), path, ["id"], bucket=b)
    W.merge_into_table(_frame(spark, [(1, "a", 9.0), (None, "a", 3.0), (6, None, 6.0)]), path, ["id"], bucket=b)
    assert sorted(r[3] for r in _read(spark, path)) == [2.0, 3.0, 5.0, 6.0, 9.0]


def test_replace_tenant_with_odd_names(spark, tmp_table):
    path = tmp_table("odd")
    names = ["a/b", "a:b", "a=b", "..", "plain", None]
    W.write_truncate(_frame(spark, [(i, t, 1.0) for i, t in enumerate(names)]), path, ("tenant_id",))
    W.replace_tenant(_frame(spark, []), path, tenants=[n for n in names if n not in ("..", "plain")])
    assert sorted(r[2] for r in _read(spark, path)) == ["..", "plain"]
    with pytest.raises(ValueError):
        W._partition_path(spark, path + "/x/..", "tenant_id", "a")


def test_repeated_keys_in_the_source(spark):
    src = _frame(spark, [(1, "a", 1.0), (1, "a", 2.0)])
    assert M.merge_on_key(src.limit(0), src, ["id"]).count() == 1
    with pytest.raises(ValueError):
        M.merge_on_key(src.limit(0), src, ["id"], strict=True)


def test_forced_full_sync_empties_a_tenant(spark, tmp_table):
    root = tmp_table("smart")
    both = _frame(spark, [(1, "a", 1.0), (2, "b", 2.0)])
    _, records = PL.smart_sync({"t": both}, root, T0, keys={"t": ["id"]})
    records = W.stage(records, "records")
    PL.smart_sync({"t": both.where("tenant_id = 'a'")}, root, T1, records, {"t": ["id"]}, force_full=True)
    assert [r[2] for r in _read(spark, root + "/t")] == ["a"]


def test_a_failing_table_keeps_its_whole_error(spark, tmp_table):
    src = _frame(spark, [(1, "a", 1.0)]).withColumn("boom", F.raise_error(F.lit("x" * 900)))
    stats, _ = PL.sync_all({"t": dict(source=src, target_path=tmp_table("fails"), plan=_plan(spark, ["a"], "FULL"),
                                      watermark=None)}, T0)
    r = stats.first()
    assert r["status"] == "FAILED" and "x" * 900 in r["error_message"]


def test_first_run_on_an_ensured_empty_target(spark, tmp_table):
    path = tmp_table("ensured")
    src = _frame(spark, [(1, "a", 1.0)])
    W.ensure_target(spark, path, add_system_columns(src, None, T0, "FULL").schema)
    PL.sync_table(src, path, "t", _plan(spark, ["a"], "FULL"), T0, "updated_at", ["id"])
    assert len(_read(spark, path)) == 1
    legacy = tmp_table("legacy")
    PL.legacy_incremental(src, legacy, "2024-01-01 00:00:00", "updated_at")
    assert len(_read(spark, legacy)) == 1


def test_incremental_bound_reaches_the_scan(spark, tmp_table):
    path, history = tmp_table("src"), tmp_table("hist")
    _frame(spark, [(1, "a", 1.0)]).write.parquet(path)
    marks = spark.createDataFrame([("a",)], "tenant_id string").withColumn(
        "last_sync_time", F.lit("2023-12-31 12:00:00").cast("timestamp_ntz"))
    marks.write.parquet(history)
    plan = W.stage(PL.incremental_plan(spark.read.parquet(history)), "plan")
    rows = PL._window_rows(spark.read.parquet(path), plan, "updated_at", T1)
    physical = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at,2023-12-31T11:50" in physical


def test_reconcile_sees_a_changed_middle_row(spark):
    a = _frame(spark, [(1, "a", float(x)) for x in (1, 2, 3, 4, 5)])
    b = _frame(spark, [(1, "a", float(x)) for x in (1, 2, 3.5, 4, 5)])
    assert {r["status"] for r in A.reconcile(a, b, ["id"]).collect()} == {"changed"}
    assert {r["status"] for r in A.reconcile(a, a, ["id"]).collect()} == {"same"}


def test_epoch_in_a_datetime_column(spark):
    df = spark.createDataFrame([(1704067200,)], "v long")
    out = df.select(C.to_target(F.col("v"), "TIMESTAMP", df.schema["v"].dataType, "datetime").alias("t")).first()
    assert str(out["t"]) == "2024-01-01 00:00:00"


def test_union_skips_and_reports_a_failing_tenant(spark, tmp_table):
    failed = {}
    good = _frame(spark, [(1, "a", 1.0)]).drop("tenant_id")
    out = PL.union_tenants({"a": good, "b": lambda: spark.read.parquet(tmp_table("absent"))}, failed)
    assert [r["tenant_id"] for r in out.collect()] == ["a"] and "PATH_NOT_FOUND" in failed["b"]


def test_unsplit_jdbc_read_is_refused(spark):
    from tablesync.sources.scans import read_jdbc
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t")


def test_report_of_a_run(spark, tmp_table):
    src = _frame(spark, [(1, "a", 1.0), (2, "b", 2.0)])
    bad = src.withColumn("boom", F.raise_error(F.lit("no")))
    plan = _plan(spark, ["a", "b"], "FULL")
    stats, _ = PL.sync_all({"t": dict(source=src, target_path=tmp_table("r1"), plan=plan, watermark=None, keys=["id"]),
                            "u": dict(source=bad, target_path=tmp_table("r2"), plan=plan, watermark=None)}, T0)
    r = PL.report_of_run(stats).first()
    assert (r["success_count"], r["failed_count"], r["total_records"]) == (2, 2, 2)
    assert r["total_duration_sec"] > 0 and r["rows_per_sec"] > 0


def test_dedup_merge_leaves_other_tenants_files(spark, tmp_table):
    import glob
    import os

    from tablesync.session import to_local
    path = tmp_table("p05")
    src = _frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)])
    W.write_truncate(with_row_hash(add_system_columns(src, None, T0, "FULL")), path, ("tenant_id",))
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(to_local(path) + "/tenant_id=c/*.parquet")}
    PL.dedup_merge(_frame(spark, [(2, "a", 9.0)]), path, T1, None, ["id"])     # moves from b to a
    assert [(r[1], r[2], r[3]) for r in _read(spark, path)] == [(1, "a", 1.0), (2, "a", 9.0), (3, "c", 3.0)]
    assert files and all(os.stat(f).st_mtime_ns == t for f, t in files.items())


def test_sync_table_normalises_and_quarantines(spark, tmp_table):
    path = tmp_table("typed")
    src = spark.createDataFrame([(1, "a", "12"), (2, "a", "junk")], "id long, tenant_id string, v string")
    PL.sync_table(src, path, "t", _plan(spark, ["a"], "FULL"), T0, None, ["id"], field_types={"id": "bigint", "v": "int"})
    got = {r["id"]: r for r in spark.read.parquet(path).collect()}
    assert (got[1]["v"], got[2]["v"], got[2]["bad_values"]) == (12, None, {"v": "junk"})
