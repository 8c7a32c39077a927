"""Control table: sync state per (tenant, table), and the decisions made
from it for all tables at once.

The control table is an append-only history of run records
``(tenant_id, table_name, last_sync_time, sync_status, sync_mode,
records_synced, error_message, updated_at)``; the current state is the newest
record per (tenant, table).  Times are kept as ISO text as in the state
documents and parsed where compared; unparsable text counts as no time.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutil import ts_lit
from ..operators.merge import latest_per_key, merge_on_key
from ..sinks import writers as W

KEY = ["tenant_id", "table_name"]
HISTORY_SCHEMA = ("tenant_id string, table_name string, last_sync_time string, sync_status string, sync_mode string, "
                  "records_synced bigint, error_message string, updated_at string")
_HISTORY_COLUMNS = [c.split()[0] for c in HISTORY_SCHEMA.split(", ")]
LOG_RUNS = 16       # runs that the control table's log holds before it is folded


def join_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (tenant, table); a NULL tenant is a tenant like any other."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in KEY})
    same = left[KEY[0]].eqNullSafe(F.col(f"_{KEY[0]}")) & left[KEY[1]].eqNullSafe(F.col(f"_{KEY[1]}"))
    out = left.join(other, same, how)
    return out if how in ("left_anti", "left_semi") else out.drop(*[f"_{k}" for k in KEY])


class ControlTable:
    """C-01/C-02 on a path: a snapshot of the control history and a log of the
    runs after it.  A run appends its records to the log; when the log holds
    ``log_runs`` runs it is folded into a new snapshot, which keeps what any plan
    or summary asks for: of every (tenant, table) the newest record and the
    newest success.  So a plan reads a bounded number of files whatever the number
    of runs.  The note that lists the parts is written last."""

    def __init__(self, spark: SparkSession, path: str, log_runs: int = LOG_RUNS):
        self.spark, self.path, self.log_runs = spark, path.rstrip("/"), log_runs
        note = W.get_note(spark, self.path, "control")
        self.parts: list[str] = note["parts"] if note else []
        # a table of an older layout: all records in tenant partitions
        self.old = note is None and W.existing_schema(spark, self.path) is not None

    def read(self) -> DataFrame:
        if self.old:
            return W.read_table(self.spark, self.path).select(*_HISTORY_COLUMNS)
        if not self.parts:
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(*[f"{self.path}/part={p}" for p in self.parts])

    def _write(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        # as few files as the rows need
        rows.select(*_HISTORY_COLUMNS).hint("rebalance").write.parquet(f"{self.path}/part={name}")
        return name

    def _list(self, parts: list[str]) -> None:
        self.parts = parts
        W.put_note(self.spark, self.path, "control", {"parts": parts})

    def append(self, records: DataFrame) -> None:
        if self.old:
            kept = self.read()
            tenants = W.touched_tenants(kept)
            self._list([self._write(kept, "snapshot")])
            self.old = False
            W.drop_tenant_partitions(self.spark, self.path, tenants)
        self._list([*self.parts, self._write(records, "log")])
        if len([p for p in self.parts if p.startswith("log")]) >= self.log_runs:
            self.fold()

    def fold(self) -> None:
        """Snapshot and log into a new snapshot; the old parts go last."""
        history = self.read()
        ok = history.where((F.col("sync_status") == "SUCCESS") & _t("last_sync_time").isNotNull())
        best = latest_per_key(ok.withColumn("_s", _t("last_sync_time")), KEY, "_s").drop("_s")
        before = self.parts
        snapshot = self._write(current_status(history).unionByName(best).distinct(), "snapshot")
        self._list([snapshot])
        fs, _ = W._fs(self.spark, self.path)
        for p in before:
            fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/part={p}"), True)


def _t(c: str):
    return F.col(c).try_cast("timestamp_ntz")


def current_status(history: DataFrame) -> DataFrame:
    """Newest record per (tenant, table), by ``updated_at`` (parsed)."""
    return latest_per_key(history.withColumn("_u", _t("updated_at")), KEY, "_u").drop("_u")


# ---------------------------------------------------------------- C-01
def last_sync_time(history: DataFrame) -> DataFrame:
    """C-01: watermark per (tenant, table) = newest *successful* sync time
    (a failed run never advances it); unparsable or missing -> no row."""
    ok = history.where(F.col("sync_status") == "SUCCESS")
    return (ok.groupBy(*KEY).agg(F.max(_t("last_sync_time")).alias("last_sync_time"))
            .where(F.col("last_sync_time").isNotNull()))


# ---------------------------------------------------------------- C-02
def upsert_status(current: DataFrame, updates: DataFrame) -> DataFrame:
    """C-02: new current state: one row per (tenant, table), updated rows
    replaced, new tables added (J-01 on the control key)."""
    return merge_on_key(current, updates.select(*current.columns), ["table_name"],
                        tenant_col="tenant_id", latest_by="updated_at")


def status_record(tables: DataFrame, run_time: datetime | str, status_col: str = "status",
                  mode_col: str = "sync_mode", rows_col: str = "records_synced",
                  error_col: str | None = "error_message") -> DataFrame:
    """Control records for a finished run (one per table), run time as text."""
    t = ts_lit(run_time)
    return tables.select(
        "tenant_id", "table_name",
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss").alias("last_sync_time"),
        F.col(status_col).alias("sync_status"), F.col(mode_col).alias("sync_mode"),
        F.col(rows_col).cast("bigint").alias("records_synced"),
        (F.col(error_col) if error_col else F.lit(None).cast("string")).alias("error_message"),
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"))


# ---------------------------------------------------------------- C-06
def safe_start(watermarks: DataFrame, lookback_minutes: float = 10,
               column: str = "last_sync_time") -> DataFrame:
    """C-06: start of the next window: last sync minus the lookback; no
    history -> 1970-01-01."""
    start = F.coalesce(F.col(column) - F.make_dt_interval(secs=F.lit(float(lookback_minutes * 60))),
                       ts_lit("1970-01-01 00:00:00"))
    return watermarks.withColumn("safe_start", start)


def history_state(history: DataFrame) -> DataFrame:
    """Per (tenant, table), in one aggregation over the history: the
    watermark of C-01 (``last_sync_time``, NULL when no successful parsable
    time) and the status of the newest record (``last_status``), chosen with
    the same order as :func:`current_status` (newest ``updated_at``, then the
    row's columns in name order, NULL lowest)."""
    h = history.withColumn("_u", _t("updated_at"))
    order = F.struct(F.col("_u"), *[F.col(f"`{c}`") for c in sorted(h.columns)])
    ok_time = F.when(F.col("sync_status") == "SUCCESS", _t("last_sync_time"))
    return h.groupBy(*KEY).agg(F.max(ok_time).alias("last_sync_time"),
                               F.max_by("sync_status", order).alias("last_status"))


# ---------------------------------------------------------------- C-03 / C-04
def sync_plan(facts: DataFrame, history: DataFrame, force_full: bool = False,
              lookback_minutes: float = 10) -> DataFrame:
    """C-03/C-04: mode, reason and write strategy for every table.

    INCREMENTAL needs a last successful sync, a watermark column, no force,
    and a last run that did not fail; otherwise FULL with the first reason
    that applies.  Write: FULL -> replace tenant; keys -> merge; else append
    new rows by hash."""
    j = join_key(facts, history_state(history), "left")
    has_wm = F.col("watermark_column").isNotNull()
    has_hist = F.col("last_sync_time").isNotNull()
    failed = F.coalesce(F.col("last_status") == "FAILED", F.lit(False))
    forced = F.lit(bool(force_full))
    mode = F.when(~forced & has_hist & has_wm & ~failed, F.lit("INCREMENTAL")).otherwise(F.lit("FULL"))
    reason = (F.when(forced, F.lit("forced"))
              .when(~has_hist & F.col("last_status").isNull(), F.lit("first sync"))
              .when(failed, F.lit("last run failed"))
              .when(~has_hist, F.lit("no successful sync"))
              .when(~has_wm, F.lit("no timestamp column"))
              .otherwise(F.lit("incremental")))
    has_keys = F.coalesce(F.size("key_columns") > 0, F.lit(False))
    write = (F.when(mode == "FULL", F.lit("replace_tenant"))
             .when(has_keys, F.lit("merge_on_key"))
             .otherwise(F.lit("append_new_by_hash")))
    start = F.when(mode == "INCREMENTAL",
                   F.col("last_sync_time") - F.make_dt_interval(secs=F.lit(float(lookback_minutes * 60))))
    return j.select(*KEY, "watermark_column", "key_columns", mode.alias("sync_mode"),
                    reason.alias("reason"), write.alias("write_strategy"),
                    start.alias("safe_start"))


def facts_of_known(facts: DataFrame, history: DataFrame) -> DataFrame:
    """Facts of the (tenant, table) pairs that the history knows and ``facts``
    lacks (no source rows any more): their table's, as its other tenants have them."""
    columns = [c for c in facts.columns if c not in KEY]
    of_table = facts.groupBy("table_name").agg(F.min(F.struct(*columns)).alias("f"))
    known = join_key(history.select(*KEY).distinct(), facts.select(*KEY), "left_anti")
    return known.join(of_table, "table_name").select(*KEY, *[F.col(f"f.{c}") for c in columns])


def sync_plan_legacy(facts: DataFrame, dedup_mode: str = "merge") -> DataFrame:
    """C-05: older strategy: key -> merge, else timestamp -> incremental,
    else hash dedup; ``dedup_mode != 'merge'`` forces the hash append."""
    has_keys = F.coalesce(F.size("key_columns") > 0, F.lit(False))
    has_wm = F.col("watermark_column").isNotNull()
    if dedup_mode.lower() != "merge":
        strategy = F.lit("append_new_by_hash")
    else:
        strategy = (F.when(has_keys, F.lit("merge_on_key"))
                    .when(has_wm, F.lit("incremental"))
                    .otherwise(F.lit("append_new_by_hash")))
    return facts.select(*KEY, "watermark_column", "key_columns", strategy.alias("strategy"))


# ---------------------------------------------------------------- A-09 / A-10
def tenant_summary(current: DataFrame) -> DataFrame:
    """A-09: per tenant: number of tables, newest update, and the table
    states (array sorted by table name; bounded by the tenant's tables)."""
    st = F.struct(*[F.col(c) for c in current.columns if c != "tenant_id"])
    return (current.groupBy("tenant_id")
            .agg(F.count(F.lit(1)).alias("total_tables"),
                 F.max(_t("updated_at")).alias("last_updated"),
                 F.sort_array(F.collect_list(st)).alias("tables")))


def sync_overview(current: DataFrame) -> DataFrame:
    """A-10: per tenant: tables, successes, full and incremental counts."""
    return (current.groupBy("tenant_id")
            .agg(F.count(F.lit(1)).alias("total_tables"),
                 F.count_if(F.col("sync_status") == "SUCCESS").alias("success_count"),
                 F.count_if(F.col("sync_mode") == "FULL").alias("full_count"),
                 F.count_if(F.col("sync_mode") == "INCREMENTAL").alias("incremental_count")))


# ---------------------------------------------------------------- W-04
def recent_tables(current: DataFrame, n: int = 3) -> DataFrame:
    """W-04: the ``n`` most recently updated tables per tenant (missing time
    last, table name breaks ties).  ``row_number() <= n`` is planned with a
    per-partition group limit before the shuffle, so a tenant with very many
    tables ships only ``n`` rows per input partition."""
    w = Window.partitionBy("tenant_id").orderBy(_t("updated_at").desc_nulls_last(),
                                                F.col("table_name"))
    return (current.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n)
            .select("tenant_id", F.col("_rn").cast("bigint").alias("rank"), "table_name",
                    F.coalesce(F.substring("last_sync_time", 1, 19), F.lit("unknown")).alias("sync_time"),
                    F.coalesce(F.col("records_synced"), F.lit(0)).alias("records_synced"),
                    F.coalesce(F.col("sync_mode"), F.lit("unknown")).alias("sync_mode")))


# ---------------------------------------------------------------- A-15
def migrate_status(legacy: DataFrame, run_time_text: str) -> DataFrame:
    """A-15: old per-table states -> per-tenant current states with the
    reference's defaults (status/mode UNKNOWN, rows 0, updated = run time);
    the file's table name is the key.  Returns one row per (tenant, table)
    plus the tenant's table count; :func:`tenant_documents` nests it."""
    rows = legacy.select(
        "tenant_id", F.col("file_table").alias("table_key"),
        F.coalesce("table_name", "file_table").alias("table_name"),
        "last_sync_time",
        F.coalesce("sync_status", F.lit("UNKNOWN")).alias("sync_status"),
        F.coalesce("sync_mode", F.lit("UNKNOWN")).alias("sync_mode"),
        F.coalesce("records_synced", F.lit(0)).cast("bigint").alias("records_synced"),
        "error_message",
        F.coalesce("updated_at", F.lit(run_time_text)).alias("updated_at"))
    # one scan: a tenant's tables are few, and are counted where they are
    w = Window.partitionBy("tenant_id")
    return rows.withColumn("total_tables", F.count(F.lit(1)).over(w))


def tenant_documents(migrated: DataFrame, run_time_text: str) -> DataFrame:
    """A-15: the per-tenant state document as the new layout stores it: tenant,
    ``last_updated``, ``total_tables`` and ``tables`` as JSON text, an object by
    table key in the order of the keys."""
    state = F.struct("table_name", "last_sync_time", "sync_status", "sync_mode", "records_synced", "error_message",
                     "updated_at")
    entry = F.struct(F.col("table_key").alias("key"), state.alias("value"))
    return (migrated.groupBy("tenant_id")
            .agg(F.count(F.lit(1)).alias("total_tables"), F.sort_array(F.collect_list(entry)).alias("_t"))
            .select("tenant_id", F.lit(run_time_text).alias("last_updated"), "total_tables",
                    F.to_json(F.map_from_entries("_t"), {"ignoreNullFields": "false"}).alias("tables")))
