"""Pipelines: compositions of scans, transforms, merges and sinks.

A table is synced for *all* its tenants in one plan: the source is one scan
carrying ``tenant_id`` (union of tenant sources, or one partitioned scan),
the per-tenant decision comes from a plan DataFrame, and the result for every
touched tenant is written by one dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_columns, row_hash, with_row_hash
from ..functions.timeutil import bound_for
from ..operators import merge as M
from ..operators.metrics import flag_present, outcome_of_flags, rows_per_tenant, run_report
from ..operators.transform import (
    SYSTEM_COLUMNS, add_system_columns, align_to_target, quarantine_bad_values,
)
from ..session import scratch_path
from ..sinks import writers as W
from ..sinks.hash_index import HashIndex, append_stored
from ..sources import scans as S
from .control import safe_start, status_record

TENANT = "tenant_id"


# ---------------------------------------------------------------- U-01
def union_tenants(frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
                  failed: dict[str, str] | None = None) -> DataFrame:
    """U-01: one DataFrame for a table over all tenant sources, each row
    tagged with its tenant; columns missing in a tenant become NULL.  A source
    may be a function that opens it; with ``failed`` given, a tenant whose
    source can't be opened is skipped and its error noted there."""
    out = None
    for tenant, source in frames.items():
        try:
            df = source() if callable(source) else source
            df.schema  # noqa: B018 - an unreadable source fails here
        except Exception as exc:
            if failed is None:
                raise
            failed[tenant] = str(exc)
            continue
        tagged = df.withColumn(TENANT, F.lit(tenant))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tenant sources")
    return out


def scan_tenants(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """U-01 (one scan): tenant directories ``tenant_id=<t>/`` under ``path``."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("basePath", path).parquet(path)


# ---------------------------------------------------------------- P-01
def _window_rows(source: DataFrame, plan: DataFrame, column: str, now) -> DataFrame:
    """Rows in each INCREMENTAL tenant's window ``(safe_start, now]``; a NULL
    tenant is a tenant like any other."""
    incr = plan.where(F.col("sync_mode") == "INCREMENTAL").select(TENANT, "safe_start")
    return (S.rows_after_bounds(source, incr, column, "safe_start", TENANT)
            .where(F.col(column) <= bound_for(source.schema[column].dataType, now)))


def sync_table(source: DataFrame, target_path: str, table_name: str, plan: DataFrame,
               run_time: datetime | str, watermark: str | None, keys: Sequence[str] = (),
               hash_dedup: bool = True, bucket: Column | None = None,
               bucket_col: str = "key_bucket",
               field_types: Mapping[str, str] | None = None) -> DataFrame:
    """P-01: sync one table for every tenant in ``plan`` (columns
    ``tenant_id, sync_mode, safe_start``) and return per-tenant statistics.

    FULL tenants: all their source rows replace the tenant (also when there
    are none).  ``field_types`` (source types by column) normalises the rows
    first, values that do not convert go to ``bad_values`` (PR-02, PR-04).
    INCREMENTAL tenants: rows in ``(safe_start, run_time]`` are
    merged on key + tenant, or appended by hash when there is no key.

    ``bucket`` (an expression of the key, or of ``data_hash`` for key-less
    tables) adds a second partition level: INCREMENTAL tenants then read and
    rewrite only the buckets their changes touch; FULL tenants are replaced
    whole and lose buckets they no longer have."""
    spark = source.sparkSession
    W.recover(spark, target_path)
    if field_types:
        source = quarantine_bad_values(source, field_types, keep=(*SYSTEM_COLUMNS, watermark or ""))
    with W.staging() as put:
        # staged: the decisions are few rows of a known size, and are taken once
        plan = put(plan.select(TENANT, "sync_mode", "safe_start"), "plan")
        if watermark is not None and not plan.where("sync_mode = 'INCREMENTAL' and safe_start is null").isEmpty():
            raise ValueError(f"{table_name}: an INCREMENTAL tenant has no safe_start (control.safe_start gives one)")
        changes, staged = _sync_rows(put, source, target_path, plan, run_time, watermark, keys, hash_dedup,
                                     bucket, bucket_col)
        counts = changes.groupBy(TENANT).agg(F.count(F.lit(1)).alias("records_synced"))
        counts = counts.withColumnRenamed(TENANT, "_tenant")
        stats = (plan.join(counts, F.col(TENANT).eqNullSafe(F.col("_tenant")), "left")
                 .select(TENANT, F.lit(table_name).alias("table_name"), "sync_mode",
                         F.coalesce("records_synced", F.lit(0)).cast("bigint").alias("records_synced"),
                         F.lit("SUCCESS").alias("status")))
        # few rows (one a tenant), which outlive the copies: the caller's to release
        return W.stage(stats, "stats")


def _sync_rows(put: Callable, source: DataFrame, target_path: str, plan: DataFrame, run_time, watermark: str | None,
               keys: Sequence[str], hash_dedup: bool, bucket: Column | None, bucket_col: str) -> tuple:
    """The data side of :func:`sync_table`; returns the rows taken from the
    source and those written."""
    spark = source.sparkSession
    full_tenants = [r[0] for r in plan.where(F.col("sync_mode") == "FULL").select(TENANT).collect()]
    full = add_system_columns(W.prune_to_tenants(source, full_tenants), None, run_time, "FULL")
    incr = _window_rows(source, plan, watermark, run_time) if watermark is not None else source.limit(0)
    incr = add_system_columns(incr, None, run_time, "INCREMENTAL")
    by_hash = hash_dedup and not keys
    both = full.unionByName(incr)
    schema = W.existing_schema(spark, target_path)
    if schema is not None and by_hash and "data_hash" not in schema.fieldNames() and not W.is_empty(spark, target_path):
        # a table loaded without hashes gets them first (SK-07)
        W.rebuild_with_hash(spark, target_path)
        schema = W.existing_schema(spark, target_path)
    parts, pairs_known = (TENANT,), True
    if bucket is not None:
        if by_hash:     # the bucket may be taken from the hash, as stored rows have it
            if schema is not None and "data_hash" in schema.fieldNames():
                given = set(both.columns)
                covered = W.hash_columns_of(spark, target_path, schema)
                pairs_known = set(covered) <= given
                both = align_to_target(both, T.StructType([f for f in schema.fields if f.name != bucket_col]))
                both = both.withColumn("data_hash", row_hash(both, columns=covered))
            else:
                both = with_row_hash(both)
        both = both.withColumn(bucket_col, bucket.cast("string"))
        parts = (TENANT, bucket_col)
    changes = put(both, "changes")

    incr_changes = changes.where(F.col("sync_mode") == "INCREMENTAL")
    full_changes = changes.where(F.col("sync_mode") == "FULL")
    if schema is not None:
        target = W.read_table(spark, target_path)
        # only INCREMENTAL tenants with changes are read (partition pruning)
        # and rewritten; FULL tenants are replaced from the source alone
        if bucket is None or not pairs_known:
            t = W.prune_to_tenants(target, W.touched_tenants(incr_changes))
        else:
            t = W.prune_to_pairs(target, incr_changes, bucket_col)
        src, full_rows = align_to_target(incr_changes, schema), align_to_target(full_changes, schema)
        if keys:
            merged = M.merge_on_key(t, src, keys, latest_by=watermark)
        elif by_hash and "data_hash" in schema.fieldNames():
            # hashed after alignment, over what the stored hash covers, and
            # compared over the columns that both sides have
            covered = W.hash_columns_of(spark, target_path, schema)
            have, new, compared = W.comparable_hashes(t, src, source.columns, covered)
            merged = t.unionByName(M.append_new_by_hash(have, new, compared).select(*t.columns))
            full_rows = W.comparable_hashes(t, full_rows, covered, covered)[1]
        else:
            merged = t.unionByName(src)
        result = full_rows.unionByName(merged)
    else:
        # the first load
        if keys:
            result = full_changes.unionByName(M.one_per_key(incr_changes, [*keys, TENANT], watermark))
        else:
            result = with_row_hash(changes) if by_hash else changes
    staged = changes if result is changes else put(result, "result")
    # FULL tenants without source rows must not keep stale rows (Q8)
    written = {r[0] for r in staged.select(TENANT).distinct().collect()}
    W.replace_partitions(staged, target_path, parts, watermark, [t for t in full_tenants if t not in written])
    if by_hash and schema is None:
        W.record_hash_columns(spark, target_path, hash_columns(staged))
    replaced = [t for t in full_tenants if t in written]
    if bucket is not None and schema is not None and replaced:
        # bucket partitions just written for the replaced tenants: as many
        # as their partition directories, which the clean-up lists anyway
        pairs = {(r[0], r[1]) for r in W.prune_to_tenants(staged, replaced)
                 .select(TENANT, bucket_col).distinct().collect()}
        W.drop_stale_buckets(spark, target_path, replaced, pairs, bucket_col)
    return changes, staged


def full_plan(tenants: DataFrame) -> DataFrame:
    return tenants.select(TENANT, F.lit("FULL").alias("sync_mode"),
                          F.lit(None).cast("timestamp_ntz").alias("safe_start"))


def incremental_plan(watermarks: DataFrame, lookback_minutes: float = 10) -> DataFrame:
    """Plan from per-tenant last sync times (C-06: a tenant without one starts
    in 1970)."""
    return safe_start(watermarks, lookback_minutes).select(
        TENANT, F.lit("INCREMENTAL").alias("sync_mode"), "safe_start")


# ---------------------------------------------------------------- P-02
def sync_all(tables: Mapping[str, dict], run_time: datetime | str,
             parallel: int = 1) -> tuple[DataFrame, DataFrame]:
    """P-02: sync every table (each over all its tenants) and return the
    per-(tenant, table) statistics and the new control records.

    ``tables[name]`` = dict(source=..., target_path=..., plan=..., watermark=...,
    keys=[...], bucket=..., field_types=...).  ``parallel`` tables run as concurrent Spark jobs
    (threads submitting jobs; the cluster shares executors between them).
    A table that fails is reported FAILED (its error kept) and the others
    continue.  ``started_at`` and ``duration_sec`` are the table's own; see
    :func:`report_of_run`."""
    if not tables:
        raise ValueError("no tables")

    def one(name: str, spec: dict) -> DataFrame:
        start = datetime.now(timezone.utc).replace(tzinfo=None)
        stats = attempt(name, spec)
        spent = (datetime.now(timezone.utc).replace(tzinfo=None) - start).total_seconds()
        return (stats.withColumn("started_at", F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
                .withColumn("duration_sec", F.lit(spent)))

    def attempt(name: str, spec: dict) -> DataFrame:
        try:
            st = sync_table(spec["source"], spec["target_path"], name, spec["plan"], run_time,
                            spec.get("watermark"), spec.get("keys", ()), bucket=spec.get("bucket"),
                            field_types=spec.get("field_types"))
            return st.withColumn("error_message", F.lit(None).cast("string"))
        except Exception as exc:  # noqa: BLE001 - report and go on with the others
            return spec["plan"].select(
                TENANT, F.lit(name).alias("table_name"), "sync_mode",
                F.lit(0).cast("bigint").alias("records_synced"), F.lit("FAILED").alias("status"),
                F.lit(str(exc)).alias("error_message"))

    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            stats = list(pool.map(lambda kv: one(*kv), tables.items()))
    else:
        stats = [one(n, s) for n, s in tables.items()]
    out = stats[0]
    for s in stats[1:]:
        out = out.unionByName(s)
    records = status_record(out, run_time)
    return out, records


def report_of_run(stats: DataFrame) -> DataFrame:
    """A-07 of a run: the summary of the statistics of :func:`sync_all`."""
    return run_report(stats.withColumnRenamed(TENANT, "database"))


# ---------------------------------------------------------------- P-03
def stage_tenants(frames: Mapping[str, DataFrame | Callable[[], DataFrame]], failed: dict[str, str],
                  parallel: int = 1) -> tuple[DataFrame, Callable[[], None]]:
    """Every tenant's rows staged by a job of its own, into its own folder, and
    one scan over all folders; columns that a tenant lacks are NULL.  A tenant
    whose source can't be opened *or read* is left out and noted in ``failed``.
    Also returns what releases the folders."""
    opened: dict[str, DataFrame] = {}
    for tenant, source in frames.items():
        try:
            opened[tenant] = source() if callable(source) else source
            opened[tenant].schema  # noqa: B018 - an unreadable source fails here
        except Exception as exc:  # noqa: BLE001 - noted, the others go on
            failed[tenant] = str(exc)
            opened.pop(tenant, None)
    if not opened:
        raise ValueError(f"no tenant could be read: {failed}")
    spark = next(iter(opened.values())).sparkSession
    union = union_tenants({t: df.limit(0) for t, df in opened.items()}).schema
    columns = T.StructType([f for f in union.fields if f.name != TENANT])
    root = scratch_path(spark, "tenants")

    def one(tenant: str) -> None:
        folder = W._partition_path(spark, root, TENANT, tenant).toString()
        try:
            align_to_target(opened[tenant], columns).write.mode("overwrite").parquet(folder)
        except Exception as exc:  # noqa: BLE001
            fs, p = W._fs(spark, folder)
            fs.delete(p, True)
            failed[tenant] = str(exc)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(one, opened))
    if set(opened) <= set(failed):
        raise ValueError(f"no tenant could be read: {failed}")

    def done() -> None:
        fs, p = W._fs(spark, root)
        fs.delete(p, True)
    return scan_tenants(spark, root, T.StructType([*columns.fields, T.StructField(TENANT, T.StringType())])), done


def multitenant_load(frames: Mapping[str, DataFrame | Callable[[], DataFrame]] | DataFrame, target_path: str,
                     run_time: datetime | str, write_mode: str = "TRUNCATE",
                     failed: dict[str, str] | None = None, parallel: int = 1) -> DataFrame:
    """P-03: union of tenants -> system columns -> write (TRUNCATE, APPEND or
    EMPTY) -> rows per tenant of the written table.

    With ``failed`` given, a tenant that fails while it is opened or read is
    left out and noted there, and all others load (see :func:`stage_tenants`)."""
    done = None
    if isinstance(frames, DataFrame):
        df = frames
    elif failed is None:
        df = union_tenants(frames)
    else:
        df, done = stage_tenants(frames, failed, parallel)
    df = add_system_columns(df, None, run_time, "FULL")
    spark = df.sparkSession
    mode = write_mode.upper()
    try:
        if mode == "TRUNCATE":
            W.write_truncate(df, target_path, (TENANT,))
        elif mode == "APPEND":
            W.write_append(df, target_path, (TENANT,))
        elif mode == "EMPTY":
            W.write_if_empty(df, target_path, (TENANT,))
        else:
            raise ValueError(f"unknown write mode {write_mode}")
    finally:
        if done:
            done()
    return rows_per_tenant(spark.read.parquet(target_path))


def load_report(loaded: DataFrame, failed: Mapping[str, str]) -> DataFrame:
    """Rows per tenant of a load with the tenants that failed: status and error."""
    ok = loaded.select(TENANT, F.lit("SUCCESS").alias("status"), "row_count",
                       F.lit(None).cast("string").alias("error_message"))
    bad = loaded.sparkSession.createDataFrame(
        [(t, "FAILED", 0, e) for t, e in sorted(failed.items())],
        f"{TENANT} string, status string, row_count bigint, error_message string")
    return ok.unionByName(bad)


# ---------------------------------------------------------------- P-04
def safe_append(source: DataFrame, target_path: str, run_time: datetime | str,
                use_index: bool = False) -> DataFrame:
    """P-04: hash every source row, append the rows whose hash the tenant
    does not have yet, return the per-tenant outcome (A-13).

    Rows are aligned to the target before they are hashed, and compared over
    the columns that source and stored hash share: a column that the source has
    gained or lost makes no row new.  ``use_index`` keeps a persistent hash index
    with the table and reads only its touched partitions."""
    spark = source.sparkSession
    W.recover(spark, target_path)
    src = add_system_columns(source, None, run_time, "FULL")
    if W.existing_schema(spark, target_path) is None:
        src = with_row_hash(src)
        with W.staging() as put:
            flagged = put(src.withColumn("_dup", F.lit(False)), "flagged")
            outcome = W.stage(outcome_of_flags(flagged), "outcome")
            W.write_append(flagged.drop("_dup"), target_path, (TENANT,))
        W.record_hash_columns(spark, target_path, hash_columns(source))
        return outcome
    W.rebuild_with_hash(spark, target_path)
    target = W.read_table(spark, target_path)
    covered = W.hash_columns_of(spark, target_path, target.schema)
    src = align_to_target(src, target.schema)
    # only the hashes of tenants present in the increment are read
    # (partition pruning; the anti-join needs just tenant and hash)
    target = W.prune_to_tenants(target, W.touched_tenants(src))
    target, src, compared = W.comparable_hashes(target, src, source.columns, covered)
    if use_index and compared == "data_hash":
        flagged = append_stored(src, target_path, index=HashIndex(spark, target_path))
        try:
            return W.stage(outcome_of_flags(flagged), "outcome")
        finally:
            W.release(flagged)
    with W.staging() as put:
        # one hash pass and one join: the flags give both the new rows (J-06)
        # and the outcome counts (A-13)
        flagged = put(flag_present(target, src, compared), "flagged")
        outcome = W.stage(outcome_of_flags(flagged), "outcome")
        W.write_append(flagged.where(~F.col("_dup")).drop("_dup", "_shared_hash"), target_path, (TENANT,))
    return outcome


# ---------------------------------------------------------------- P-05
def dedup_merge(source: DataFrame, target_path: str, run_time: datetime | str,
                incremental_field: str | None, keys: Sequence[str] = ()) -> None:
    """P-05: rows newer than the last load (SC-06) -> system columns + hash
    -> merge on the key alone (J-02) or on hash + tenant (J-03).  Only the
    tenants of the new rows, and those that lose a row to them, are rewritten."""
    spark = source.sparkSession
    W.recover(spark, target_path)
    schema = W.existing_schema(spark, target_path)
    if schema is None:
        src = with_row_hash(add_system_columns(source, None, run_time, "INCREMENTAL"))
        W.overwrite_partitions(src, target_path, (TENANT,))
        W.record_hash_columns(spark, target_path, hash_columns(source))
        return
    if "data_hash" not in schema.fieldNames():
        W.rebuild_with_hash(spark, target_path)
    target = W.read_table(spark, target_path)
    src = S.since_last_load(source, target, incremental_field) if incremental_field else source
    covered = W.hash_columns_of(spark, target_path, target.schema)
    src = align_to_target(add_system_columns(src, None, run_time, "INCREMENTAL"), target.schema)
    have, src, compared = W.comparable_hashes(target, src, source.columns, covered)
    with W.staging() as put:
        src = put(src, "dedup-src")
        touched = set(W.touched_tenants(src))
        if keys:
            # keys alone may move a row to another tenant
            touched |= set(W.touched_tenants(target.join(src.select(*keys), list(keys), "left_semi")))
        t = W.prune_to_tenants(have, list(touched))
        if keys:
            merged = M.merge_on_key_only(t, src, keys, incremental_field)
        elif compared == "data_hash":
            merged = M.merge_on_hash(t, src)
        else:   # equal over the shared columns: the target's row knows more
            merged = t.unionByName(M.append_new_by_hash(t, src, compared))
        merged = merged.select(*target.columns)
        staged = put(merged, "dedup")
        left = set(W.touched_tenants(staged))
        W.replace_partitions(staged, target_path, (TENANT,), empty=[x for x in touched if x not in left])


# ---------------------------------------------------------------- P-06
def legacy_incremental(source: DataFrame, target_path: str, run_time: datetime | str,
                       watermark: str, lookback_hours: float = 1, bootstrap_hours: float = 24,
                       shared_columns: bool = False, key: str | None = None) -> None:
    """P-06: per tenant, newest watermark in the target (A-02) -> rows after
    it minus the lookback (SC-04); tenants without history get the last
    ``bootstrap_hours`` only (SC-05) -> merge on (timestamp, tenant) (J-04),
    or the schema-tolerant merge over shared columns (J-05)."""
    spark = source.sparkSession
    W.recover(spark, target_path)
    merge_key = (key or watermark) if shared_columns else watermark
    if W.existing_schema(spark, target_path) is None:
        # first run: the recent rows of every tenant, one per key of the later merges
        first = add_system_columns(S.bootstrap_recent(source, watermark, run_time, bootstrap_hours),
                                   None, run_time, "INCREMENTAL")
        W.overwrite_partitions(M.one_per_key(first, [merge_key, TENANT], watermark), target_path,
                               (TENANT,), watermark)
        return
    target = W.read_table(spark, target_path)
    with W.staging() as put:
        last = put(S.last_value_per_tenant(target, watermark), "legacy-last")
        with_hist = S.lookback_after(source, last, watermark, lookback_hours)
        known = last.select(F.col(TENANT).alias("_known"))
        fresh = S.bootstrap_recent(source, watermark, run_time, bootstrap_hours).join(
            known, F.col(TENANT).eqNullSafe(F.col("_known")), "left_anti")
        src = put(add_system_columns(with_hist.unionByName(fresh), None, run_time, "INCREMENTAL"), "legacy-src")
        t = W.prune_to_tenants(target, W.touched_tenants(src))
        if shared_columns:
            merged = M.merge_shared_columns(t, src, [merge_key], latest_by=watermark)
        else:
            merged = M.merge_on_timestamp(t, align_to_target(src, target.schema), watermark)
        staged = put(merged, "legacy")
        W.replace_partitions(staged, target_path, (TENANT,), watermark)


# ---------------------------------------------------------------- P-02, end to end
def smart_sync(sources: Mapping[str, DataFrame], target_root: str, run_time: datetime | str,
               history: DataFrame | None = None, keys: Mapping[str, Sequence[str]] | None = None,
               force_full: bool = False, lookback_minutes: float = 10,
               parallel: int = 1, control_path: str | None = None,
               field_types: Mapping[str, Mapping[str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """The whole run, as the reference's main program does it: describe the
    sources, decide mode/reason/strategy for every (tenant, table) from the
    catalog and the control history (C-03: last *successful* sync, last run
    not failed, watermark column present), sync each table for all its
    tenants, and return the run statistics and the new control records
    (append them to the history).

    ``sources[table]`` carries ``tenant_id``; targets are
    ``{target_root}/{table}``.  The plan is control-plane metadata (one row
    per tenant and table) and drives one ``sync_table`` per table: its
    ``write_strategy`` says whether increments are merged on the plan's key
    columns or appended by hash.  A tenant that the history knows and the source
    has no rows of is planned like the others; where that gives FULL it is emptied.

    ``field_types[table]`` are the source's types by column (as its catalog has
    them): the rows are converted first, what does not convert goes to
    ``bad_values`` (PR-02, PR-04).

    ``control_path``: the control table (:class:`control.ControlTable`).  History
    is read from it and the run's records are appended
    after the data writes, so a crash in between only repeats an idempotent
    merge on the next run."""
    from ..sources.catalog import describe_sources, table_facts
    from .control import HISTORY_SCHEMA, ControlTable, facts_of_known, sync_plan
    spark = next(iter(sources.values())).sparkSession
    facts = table_facts(describe_sources(dict(sources), dict(keys or {})))
    control = ControlTable(spark, control_path) if control_path else None
    if history is None:
        history = control.read() if control else spark.createDataFrame([], HISTORY_SCHEMA)
    facts = facts.unionByName(facts_of_known(facts, history.where(F.col("table_name").isin(list(sources)))))
    with W.staging() as put:
        plan = put(sync_plan(facts, history, force_full, lookback_minutes), "sync-plan")
        specs = {}
        for table, src in sources.items():
            tp = plan.where(F.col("table_name") == table)
            chosen = tp.select("watermark_column", "write_strategy", "key_columns").distinct().collect()
            wm = [r["watermark_column"] for r in chosen if r["watermark_column"] is not None]
            merge_keys = next((list(r["key_columns"]) for r in chosen if r["key_columns"]), [])
            if any(r["write_strategy"] == "append_new_by_hash" for r in chosen):
                merge_keys = []
            specs[table] = dict(source=src, target_path=f"{target_root.rstrip('/')}/{table}",
                                plan=tp.select(TENANT, "sync_mode", "safe_start"),
                                watermark=wm[0] if wm else None, keys=merge_keys,
                                field_types=(field_types or {}).get(table))
        stats, records = sync_all(specs, run_time, parallel)
        stats = W.stage(stats, "run-stats")
        records = status_record(stats, run_time)
    if control:
        control.append(records)
    return stats, records


__all__ = [
    "union_tenants", "scan_tenants", "stage_tenants", "load_report", "sync_table", "full_plan", "incremental_plan", "sync_all", "report_of_run",
    "multitenant_load", "safe_append", "dedup_merge", "legacy_incremental", "smart_sync",
]
