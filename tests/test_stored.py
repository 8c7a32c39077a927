"""Stored state: hash index, journal, ensured schema, control table, bounds per
tenant, digest tree, footers, tenant isolation, duplicate removal in a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.hashing import double_text, with_row_hash
from tablesync.operators import metrics as A
from tablesync.operators.transform import add_system_columns
from tablesync.plans import control as CT
from tablesync.plans import pipeline as PL
from tablesync.session import checkpoint_root
from tablesync.sinks import writers as W
from tablesync.sinks.hash_index import HashIndex
from tablesync.sources import scans as S
from tablesync.streaming import upsert as U

T0 = "2024-01-10 00:00:00"
T1 = "2024-02-10 00:00:00"
SCHEMA = "id long, tenant_id string, v double, updated_at timestamp_ntz"


def _frame(spark, rows):
    """(id, tenant, v, day of January 2024)"""
    day = datetime(2024, 1, 1)
    return spark.createDataFrame([(i, t, v, day + timedelta(days=d)) for i, t, v, d in rows], SCHEMA)


def _plan(spark, rows):
    return spark.createDataFrame(rows, "tenant_id string, sync_mode string, safe_start timestamp_ntz")


def _copies(spark):
    """What lies in the scratch folder."""
    fs, p = W._fs(spark, checkpoint_root(spark) + "/tablesync-scratch")
    return {st.getPath().getName() for st in fs.listStatus(p)} if fs.exists(p) else set()


# ---------------------------------------------------------------- PR-10
def test_double_text_is_exact(spark):
    rng = random.Random(8)
    values = [rng.uniform(-1, 1) * 2.0 ** rng.randint(-900, 900) for _ in range(400)]
    values += [2.0 ** e for e in range(-60, 60)] + [0.1, 1 / 3, 1e300, 5e-300, 0.0, -2.5]
    got = spark.createDataFrame([(x,) for x in values], "v double").select("v", double_text(F.col("v")).alias("t"))
    for v, t in got.collect():
        if v == 0:
            assert t == "0"
            continue
        mantissa, _, exponent = t.partition("p")
        assert 2 ** 52 <= abs(int(mantissa)) < 2 ** 53
        assert (int(mantissa) * 2.0 ** (int(exponent) - 52)).hex() == v.hex()


# ---------------------------------------------------------------- columns that come and go
def test_a_source_column_more_makes_no_row_new(spark, tmp_table):
    path = tmp_table("more")
    rows = _frame(spark, [(1, "a", 1.0, 1), (2, "a", 2.0, 2)])
    PL.safe_append(rows, path, T0)
    PL.safe_append(rows.withColumn("extra", F.lit("x")), path, T1)
    assert spark.read.parquet(path).count() == 2
    less = rows.drop("v").unionByName(_frame(spark, [(3, "a", 0.0, 3)]).drop("v"))
    out = {r["is_total"]: r["new_rows"] for r in PL.safe_append(less, path, T1).collect()}
    assert out[True] == 1 and spark.read.parquet(path).count() == 3
    # the appended row's hash covers what the table's hashes cover
    again = PL.safe_append(_frame(spark, [(3, "a", 0.0, 3)]).withColumn("v", F.lit(None).cast("double")), path, T1)
    assert again.where("is_total").first()["new_rows"] == 0


def test_keyless_increment_on_a_table_without_hash(spark, tmp_table):
    path = tmp_table("nohash")
    rows = _frame(spark, [(1, "a", 1.0, 1), (2, "a", 2.0, 2)])
    W.write_truncate(add_system_columns(rows, None, T0, "FULL"), path, ("tenant_id",))
    PL.sync_table(rows.withColumn("extra", F.lit(1)), path, "t",
                  _plan(spark, [("a", "INCREMENTAL", datetime(2023, 12, 1))]), T1, "updated_at")
    assert spark.read.parquet(path).count() == 2


def test_no_shared_column_is_an_error(spark, tmp_table):
    path = tmp_table("other")
    PL.safe_append(_frame(spark, [(1, "a", 1.0, 1)]), path, T0)
    with pytest.raises(ValueError):
        PL.safe_append(spark.createDataFrame([("a", 1)], "tenant_id string, other long"), path, T1)


# ---------------------------------------------------------------- lost tenants
def test_incremental_without_start_is_refused(spark, tmp_table):
    with pytest.raises(ValueError):
        PL.sync_table(_frame(spark, [(1, "a", 1.0, 1)]), tmp_table("x"), "t",
                      _plan(spark, [("a", "INCREMENTAL", None)]), T1, "updated_at", ["id"])


def test_never_synced_and_null_tenants_get_their_rows(spark, tmp_table):
    path = tmp_table("lost")
    rows = _frame(spark, [(1, "a", 1.0, 1), (2, "b", 2.0, 2), (3, None, 3.0, 3)])
    marks = spark.createDataFrame([("a", datetime(2023, 12, 1)), ("b", None), (None, datetime(2023, 12, 1))],
                                  "tenant_id string, last_sync_time timestamp_ntz")
    stats = PL.sync_table(rows, path, "t", PL.incremental_plan(marks), T1, "updated_at", ["id"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert {r["tenant_id"]: r["records_synced"] for r in stats.collect()} == {"a": 1, "b": 1, None: 1}


def test_an_emptied_tenant_is_emptied_by_any_full_run(spark, tmp_table):
    root = tmp_table("emptied")
    both = _frame(spark, [(1, "a", 1.0, 1), (2, "b", 2.0, 1)])
    _, records = PL.smart_sync({"t": both}, root, T0, keys={"t": ["id"]})
    failed = W.stage(records.withColumn("sync_status", F.lit("FAILED")), "failed")
    PL.smart_sync({"t": both.where("tenant_id = 'a'")}, root, T1, failed, {"t": ["id"]})
    assert [r["tenant_id"] for r in spark.read.parquet(root + "/t").collect()] == ["a"]


# ---------------------------------------------------------------- copies
def test_nothing_is_left_behind(spark, tmp_table):
    rows = _frame(spark, [(1, "a", 1.0, 1)])
    bad = rows.withColumn("boom", F.raise_error(F.lit("no")))
    path = tmp_table("left")
    before = _copies(spark)
    with pytest.raises(Exception, match="no"):
        PL.sync_table(bad, path, "t", _plan(spark, [("a", "FULL", None)]), T0, "updated_at", ["id"])
    with pytest.raises(Exception, match="no"):
        PL.safe_append(bad, path, T0)
    assert _copies(spark) == before
    stats = PL.sync_table(rows, path, "t", _plan(spark, [("a", "FULL", None)]), T0, "updated_at", ["id"])
    W.release(stats)
    assert {x for x in _copies(spark) - before if not x.startswith("left")} == set()


# ---------------------------------------------------------------- SK-06
def test_an_interrupted_replacement_is_finished(spark, tmp_table, monkeypatch):
    path = tmp_table("journal")
    W.write_truncate(_frame(spark, [(i, t, 1.0, 1) for i, t in enumerate("abcd")]), path, ("tenant_id",))
    whole = W.overwrite_partitions

    def half(df, *args):
        whole(df.where("tenant_id = 'a'"), *args)       # one partition in, then the driver is gone
        raise RuntimeError("driver lost")
    monkeypatch.setattr(W, "overwrite_partitions", half)
    with pytest.raises(RuntimeError):
        W.merge_into_table(_frame(spark, [(i, t, 9.0, 2) for i, t in enumerate("abc")]), path, ["id"])
    monkeypatch.undo()
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1.0, 1.0, 1.0, 9.0]
    assert W.recover(spark, path) == 1 and W.recover(spark, path) == 0
    assert sorted((r["tenant_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [
        ("a", 9.0), ("b", 9.0), ("c", 9.0), ("d", 1.0)]
    assert not W.notes(spark, path, "replace-")


def test_the_next_run_recovers_by_itself(spark, tmp_table, monkeypatch):
    path = tmp_table("journal2")
    rows = _frame(spark, [(1, "a", 1.0, 1), (2, "b", 1.0, 1)])
    full = _plan(spark, [("a", "FULL", None), ("b", "FULL", None)])
    PL.sync_table(rows, path, "t", full, T0, "updated_at", ["id"])
    monkeypatch.setattr(W, "overwrite_partitions", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        PL.sync_table(rows.withColumn("v", F.lit(5.0)), path, "t", full, T0, "updated_at", ["id"])
    monkeypatch.undo()
    PL.sync_table(rows.limit(0), path, "t", _plan(spark, [("a", "INCREMENTAL", datetime(2024, 1, 1))]), T1,
                  "updated_at", ["id"])
    assert {r["v"] for r in spark.read.parquet(path).collect()} == {5.0}


# ---------------------------------------------------------------- SK-04
def test_an_ensured_schema_is_kept(spark, tmp_table):
    path = tmp_table("ensured")
    schema = T.StructType.fromDDL("id bigint, v double, tenant_id string")
    W.ensure_target(spark, path, schema)
    assert W.existing_schema(spark, path) == schema and W.is_empty(spark, path)
    W.write_append(spark.createDataFrame([("7", "a")], "id string, tenant_id string"), path, ("tenant_id",))
    out = W.read_table(spark, path)
    assert dict(out.dtypes)["id"] == "bigint" and out.first()["v"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        W.write_append(spark.createDataFrame([("no number", "a")], "id string, tenant_id string"), path, ("tenant_id",))


# ---------------------------------------------------------------- J-06, U-02, A-04
def _hashed(spark, rows):
    return with_row_hash(add_system_columns(_frame(spark, rows), None, T0, "FULL"))


def _index_equals_recount(spark, path):
    index = HashIndex(spark, path)
    tenants = [r[0] for r in spark.read.parquet(path).select("tenant_id").distinct().collect()]
    index.refresh(tenants)
    have = sorted(map(tuple, index._read().select("tenant_id", "data_hash").collect()), key=repr)
    want = sorted(map(tuple, spark.read.parquet(path).select("tenant_id", "data_hash").distinct().collect()), key=repr)
    return have == want


def test_index_reads_touched_prefixes_only(spark, tmp_table):
    path = tmp_table("index")
    W.write_append(_hashed(spark, [(i, "ab"[i % 2], float(i), 1) for i in range(400)]), path, ("tenant_id",))
    out = PL.safe_append(_frame(spark, [(i, "a", float(i), 1) for i in range(0, 8)]), path, T1, use_index=True)
    assert out.where("is_total").first()["new_rows"] == 4       # odd ids are b's
    index = HashIndex(spark, path)
    one = _hashed(spark, [(2, "a", 2.0, 1)])
    known = index.known(one)
    plan = known._jdf.queryExecution().executedPlan().toString()
    prefix = one.first()["data_hash"][:2]
    assert "PartitionFilters: [" in plan and "hash_prefix" in plan.split("PartitionFilters: [")[1]
    files = known.select(F.input_file_name()).distinct().collect()
    assert files and all(f"tenant_id=a/hash_prefix={prefix}/" in f[0] for f in files)
    assert _index_equals_recount(spark, path)


def test_index_after_a_crash_between_the_writes(spark, tmp_table, monkeypatch):
    path = tmp_table("crash")
    PL.safe_append(_frame(spark, [(1, "a", 1.0, 1)]), path, T0)
    PL.safe_append(_frame(spark, [(2, "a", 2.0, 1)]), path, T0, use_index=True)
    monkeypatch.setattr(HashIndex, "add", lambda self, rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        PL.safe_append(_frame(spark, [(3, "a", 3.0, 1), (4, "b", 4.0, 1)]), path, T0, use_index=True)
    monkeypatch.undo()
    assert HashIndex(spark, path).stale(["a", "b"]) == ["a", "b"]
    out = PL.safe_append(_frame(spark, [(3, "a", 3.0, 1), (4, "b", 4.0, 1), (5, "b", 5.0, 1)]), path, T0, use_index=True)
    assert out.where("is_total").first()["new_rows"] == 1
    assert _index_equals_recount(spark, path)


def test_index_notices_other_writers(spark, tmp_table):
    path = tmp_table("others")
    for i in range(10):         # more appends than files are kept apart
        PL.safe_append(_frame(spark, [(i, "a", float(i), 1), (i, None, float(i), 1)]), path, T0, use_index=True)
    assert HashIndex(spark, path).stale(["a", None]) == [] and _index_equals_recount(spark, path)
    W.replace_tenant(_hashed(spark, [(99, "a", 9.0, 1)]), path)
    out = PL.safe_append(_frame(spark, [(1, "a", 1.0, 1), (99, "a", 9.0, 1), (1, None, 1.0, 1)]), path, T0, use_index=True)
    assert out.where("is_total").first()["new_rows"] == 1 and _index_equals_recount(spark, path)


# ---------------------------------------------------------------- SC-04, P-06
@pytest.mark.parametrize("partitioned", [False, True])
def test_one_late_tenant_does_not_widen_the_scan(spark, tmp_table, partitioned):
    path, target = tmp_table("bounds"), tmp_table("bounds-target")
    rows = spark.range(20_000).select(
        "id", F.concat(F.lit("t"), (F.col("id") % 10).cast("string")).alias("tenant_id"),
        (F.lit(datetime(2023, 1, 1)).cast("timestamp_ntz") + F.expr("make_dt_interval(0, cast(id as int) div 50)")).alias("ts"))
    w = rows.repartitionByRange(40, "ts").sortWithinPartitions("ts").write
    (w.partitionBy("tenant_id") if partitioned else w).parquet(path)
    src = spark.read.parquet(path)
    last = F.max("ts") - F.expr("INTERVAL 2 HOURS")
    late = F.when(F.col("tenant_id") == "t3", F.lit(datetime(2023, 1, 5)).cast("timestamp_ntz"))
    marks = rows.groupBy("tenant_id").agg(last.alias("l")).select("tenant_id", F.coalesce(late, "l").alias("ts"))
    marks.write.parquet(target)
    out = S.lookback_scan(src, spark.read.parquet(target), "ts", 1, partitioned=partitioned)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2023-01-0" in plan
    got = out.count()
    assert got == rows.join(marks.select("tenant_id", F.col("ts").alias("m")), "tenant_id").where(
        F.col("ts") > F.col("m") - F.expr("INTERVAL 1 HOUR")).count()
    if partitioned:     # the other tenants' scan starts at their own bound
        assert plan.count("FileScan parquet") == 2 and "GreaterThan(ts,2023-01-17" in plan


def test_bound_groups_cut_at_the_gaps():
    groups = S._bound_groups([("a", 100), ("b", 101), ("late", 1), ("c", 102), (None, 100)], 2)
    assert [(low, set(t)) for low, t in groups] == [(1, {"late"}), (100, {"a", "b", "c", None})]
    assert len(S._bound_groups([(str(i), i) for i in range(500)], 8)) == 8
    assert S._bound_groups([("a", 5), ("b", 5)], 8) == [(5, ["a", "b"])]


# ---------------------------------------------------------------- A-16
def _classes(df):
    return sorted(tuple(r) for r in df.select("tenant_id", "status", "row_count").collect())


def test_digest_tree_has_the_classes_of_reconcile(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(500), rng.choice("abc"), float(rng.randrange(50)), 1) for _ in range(900)]
    other = [(i, t, v + (rng.random() < 0.02), d) for i, t, v, d in rows if t == "c" or rng.random() > 0.03]
    rows += [(None, "a", 1.0, 1)]
    a, b = _frame(spark, rows), _frame(spark, other)
    assert _classes(A.reconcile_tree(a, b, ["id"])) == _classes(A.reconcile(a, b, ["id"]))
    assert _classes(A.reconcile_tree(a, b, ["id"], levels=(2, 5))) == _classes(A.reconcile(a, b, ["id"]))
    assert A.reconcile_tree(a.limit(0), b.limit(0), ["id"]).count() == 0


def test_swapped_rows_of_two_keys_differ(spark):
    a = _frame(spark, [(1, "a", 1.0, 1), (2, "a", 2.0, 1)])
    b = _frame(spark, [(1, "a", 2.0, 1), (2, "a", 1.0, 1)])
    assert _classes(A.reconcile_tree(a, b, ["id"], compare=["v"], levels=(1,))) == [("a", "changed", 2)]


def test_an_equal_tenant_sends_no_row_through_a_join(spark):
    rows = [(i, t, float(i), 1) for i in range(300) for t in ("same", "other")]
    a = _frame(spark, rows)
    b = _frame(spark, [(i, t, v + (t == "other" and i == 7), d) for i, t, v, d in rows])
    ks, cols = ["id", "tenant_id"], ["id", "v"]
    hashed = [A._hashed(x, ks, cols) for x in (a, b)]
    ranges, equal = A.differing_ranges(*[A.digest_tree(h, ks) for h in hashed])
    sent = [A.rows_in_ranges(h, ranges, ks).groupBy("tenant_id").count().collect() for h in hashed]
    assert [[(r["tenant_id"], r["count"]) for r in s] for s in sent] == [[("other", 1)]] * 2
    assert {r["tenant_id"]: r["row_count"] for r in equal.collect()} == {"same": 300, "other": 299}


# ---------------------------------------------------------------- A-01, A-02
def test_newest_value_comes_from_footers(spark, tmp_table):
    path = tmp_table("footers")
    W.write_truncate(_frame(spark, [(i, "ab"[i % 2], 1.0, 1) for i in range(50)]), path, ("tenant_id",))
    with A._footer_reader(spark):
        plan = A._newest(spark, path, "id", "tenant_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id)]" in plan and "PushedGroupBy: [tenant_id]" in plan
    assert sorted(tuple(r) for r in A.newest_from_metadata(spark, path, "id", "tenant_id").collect()) == [
        ("a", 48), ("b", 49)]
    assert A.newest_from_metadata(spark, path, "updated_at").first()[0] == datetime(2024, 1, 2)
    assert "FileScan parquet" in spark.read.parquet(path)._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- C-01, C-02
def test_control_table_of_200_runs(spark, tmp_table):
    path = tmp_table("control")
    rng = random.Random(3)
    rows, control = [], CT.ControlTable(spark, path)
    for run in range(200):
        at = (datetime(2024, 1, 1) + timedelta(hours=run)).isoformat()
        rows.append((rng.choice(["a", "b", None]), rng.choice(["t", "u"]), at, rng.choice(["SUCCESS", "FAILED"]),
                     "FULL", run, None, at))
        control.append(spark.createDataFrame(rows[-1:], CT.HISTORY_SCHEMA))
    again = CT.ControlTable(spark, path)
    whole = spark.createDataFrame(rows, CT.HISTORY_SCHEMA)
    assert len(again.read().inputFiles()) < 60 and again.read().count() < 60
    for of in (CT.last_sync_time, CT.current_status, CT.history_state, CT.sync_overview):
        arg = (lambda h: h) if of is not CT.sync_overview else CT.current_status
        assert sorted(map(tuple, of(arg(again.read())).collect()), key=repr) == sorted(
            map(tuple, of(arg(whole)).collect()), key=repr)


def test_control_table_of_the_older_layout(spark, tmp_table):
    path = tmp_table("old-control")
    rows = [("a", "t", T0, "SUCCESS", "FULL", 1, None, T0), (None, "t", T0, "SUCCESS", "FULL", 1, None, T0)]
    old = spark.createDataFrame(rows, CT.HISTORY_SCHEMA)
    W.write_append(old, path, ("tenant_id",))
    control = CT.ControlTable(spark, path)
    assert control.read().count() == 2
    control.append(old.withColumn("updated_at", F.lit(T1)))
    assert CT.ControlTable(spark, path).read().count() == 4
    assert CT.current_status(spark.read.parquet(path)).count() == 2


# ---------------------------------------------------------------- P-03, U-01
def test_a_tenant_that_fails_while_it_is_read(spark, tmp_table):
    good = _frame(spark, [(1, "a", 1.0, 1)]).drop("tenant_id")
    bad = good.withColumn("v", F.raise_error(F.lit("broken page")).cast("double"))
    failed = {}
    out = PL.multitenant_load({"a": good, "b": bad, "c": good.drop("v")}, tmp_table("mt"), T0, failed=failed)
    assert {r["tenant_id"]: r["row_count"] for r in out.collect()} == {"a": 1, "c": 1}
    assert list(failed) == ["b"] and "broken page" in failed["b"]
    report = {r["tenant_id"]: r["status"] for r in PL.load_report(out, failed).collect()}
    assert report == {"a": "SUCCESS", "b": "FAILED", "c": "SUCCESS"}
    with pytest.raises(ValueError):
        PL.multitenant_load({"b": bad}, tmp_table("mt2"), T0, failed={})


def test_tenants_are_read_in_one_scan(spark, tmp_table):
    frame = _frame(spark, [(1, "a", 1.0, 1)]).drop("tenant_id")
    df, done = PL.stage_tenants({t: frame for t in ("a", "b/c", "d")}, {})
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert sorted(r["tenant_id"] for r in df.collect()) == ["a", "b/c", "d"]
    done()


# ---------------------------------------------------------------- ST-01
def test_stream_removes_repeated_deliveries(spark, tmp_table):
    inp, out = tmp_table("in"), tmp_table("out")
    schema = T.StructType.fromDDL(SCHEMA + ", version long")

    def deliver(*rows):
        _frame(spark, [r[:4] for r in rows]).withColumn("version", F.lit(rows[0][4]).cast("long")).coalesce(1) \
            .write.mode("append").parquet(inp)
    deliver((1, "a", 1.0, 1, 1), (1, "b", 1.0, 1, 1), (1, "a", 1.0, 1, 1))     # the same key in two tenants, repeated
    deliver((1, "a", 1.0, 1, 1), (None, "a", 4.0, 1, 1))
    deliver((1, "a", 2.0, 1, 2))                                                # newer, inside the delay
    deliver((2, "a", 5.0, 20, 1))                                               # moves the watermark,
    deliver((4, "a", 6.0, 21, 1))                                               # which holds from the batch after
    deliver((3, "a", 3.0, 2, 1), (1, "b", 9.0, 1, 0))                           # a late row, and a late older version
    for i in range(6):
        deliver((10 + i, "a", 0.0, 40 + 5 * i, 1))
    counts = U.stream_upsert_distinct(spark, inp, schema, out, ["id"], "updated_at", "version", "1 day",
                                      files_per_batch=1)
    got = {(r["id"], r["tenant_id"]): r["v"] for r in spark.read.parquet(out).collect()}
    assert got[1, "a"] == 2.0 and got[1, "b"] == 1.0 and got[3, "a"] == 3.0 and got[None, "a"] == 4.0
    assert counts["late"] == 1 and counts["state"] <= 4        # what a day of event time holds
    assert spark.read.parquet(out).count() == 12


# ---------------------------------------------------------------- SC-10
@pytest.mark.parametrize("ties", [False, True])
def test_pages_by_bounds_are_those_of_the_numbering(spark, tmp_table, ties):
    path = tmp_table("pages")
    rng = random.Random(5)
    rows = [(i, "a", 1.0, 3 if ties and rng.random() < 0.5 else rng.randrange(40)) for i in range(1234)]
    _frame(spark, rows).write.parquet(path)
    src = spark.read.parquet(path)
    bounds = sorted(tuple(r) for r in S.page_bounds(src, "updated_at", "id", 100).collect())
    numbered = {}
    for r in S.paged_scan(src, "updated_at", "id", 100).collect():
        numbered.setdefault(r["page_no"], []).append((r["updated_at"], r["id"]))
    assert [(p, *min(numbered[p]), len(numbered[p])) for p in sorted(numbered)] == bounds
    for i in (0, 5, 12):
        after = bounds[i + 1][1:3] if i + 1 < len(bounds) else None
        page = S.read_page(src, "updated_at", "id", bounds[i][1:3], after)
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "GreaterThanOrEqual(updated_at" in plan
        assert sorted((r["updated_at"], r["id"]) for r in page.collect()) == sorted(numbered[i])
    assert S.page_bounds(src.limit(0), "updated_at", "id", 100).count() == 0
