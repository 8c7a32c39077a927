"""Aggregations: load times, per-tenant counts, verification, run reports,
change statistics, append outcome and source/target reconciliation.

All are ``groupBy``/``agg`` plans with map-side partial aggregation; the
grouping keys are tenants (few) or (tenant, key) pairs (many), never one
task per unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import row_hash
from ..functions.timeutil import bound_for

TENANT = "tenant_id"
SYSTEM_COLUMNS = ("tenant_id", "sync_timestamp", "sync_mode", "data_hash")


# ---------------------------------------------------------------- A-01
def last_load_time(target: DataFrame, column: str = "sync_timestamp") -> DataFrame:
    """A-01: newest load time over the whole table (all tenants)."""
    return target.agg(F.max(column).alias("last_load_time"))


# ---------------------------------------------------------------- A-02
def last_data_timestamp(target: DataFrame, column: str, by: str = TENANT) -> DataFrame:
    """A-02: newest watermark per tenant as epoch seconds; 0 / NULL -> none
    (the tenant is absent from the result)."""
    dt = target.schema[column].dataType
    mx = F.max(column)
    val = mx.cast("bigint") if isinstance(dt, T.IntegralType) else F.unix_timestamp(mx)
    return (target.groupBy(by).agg(val.alias("last_timestamp"))
            .where(F.coalesce(F.col("last_timestamp"), F.lit(0)) != 0))


@contextmanager
def _footer_reader(spark: SparkSession) -> Iterator[None]:
    """The v2 Parquet reader with aggregate push-down, for the length of a block."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _newest(spark: SparkSession, path: str, column: str, by: str | None) -> DataFrame:
    rows = spark.read.parquet(path)
    return (rows.groupBy(by) if by else rows).agg(F.max(column).alias("newest"))


def newest_from_metadata(spark: SparkSession, path: str, column: str, by: str | None = None) -> DataFrame:
    """A-01 / A-02 of a stored table from its Parquet footers: the v2 reader
    with aggregate push-down answers ``max`` (by the partition column ``by``) from
    the row groups' statistics, so no data page is read.  Numbers and dates are
    answered so; for other types (timestamps, text), or files without statistics,
    Spark plans the scan and aggregate itself: the same rows at the cost of a scan
    of the column.

    Columns: ``by`` if given, ``newest``: a row a tenant, which is fetched while
    the reader is set and given back as a local table."""
    with _footer_reader(spark):
        out = _newest(spark, path, column, by)
        return spark.createDataFrame(out.collect(), out.schema)


# ---------------------------------------------------------------- A-03
def rows_per_tenant(df: DataFrame, by: str = TENANT) -> DataFrame:
    """A-03: row count per tenant."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"))


# ---------------------------------------------------------------- A-05
def load_verification(target: DataFrame, by: str = TENANT, hash_col: str = "data_hash",
                      load_col: str = "sync_timestamp") -> DataFrame:
    """A-05: rows, distinct hashes and latest load per tenant, by tenant.

    ``count(DISTINCT hash)`` is planned as a two-level aggregate on
    (tenant, hash), so a huge tenant is spread over many tasks."""
    return (target.groupBy(by)
            .agg(F.count(F.lit(1)).alias("total_rows"),
                 F.countDistinct(hash_col).alias("unique_hashes"),
                 F.max(load_col).alias("latest_sync"))
            .orderBy(by))


# ---------------------------------------------------------------- A-07 / A-08
def run_report(stats: DataFrame) -> DataFrame:
    """A-07: one-row run summary from per-table run statistics
    (database, table_name, status, sync_mode, records_synced, started_at,
    duration_sec).  Rows count only for successful tables; throughput is
    NULL when rows or duration is zero."""
    ok = F.col("status") == "SUCCESS"
    ended = F.col("started_at") + F.make_dt_interval(secs=F.col("duration_sec"))
    r = stats.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(ok).alias("success_count"),
        F.count_if(~ok).alias("failed_count"),
        F.coalesce(F.sum(F.when(ok, F.col("records_synced"))), F.lit(0)).cast("bigint").alias("total_records"),
        F.count_if(ok & (F.col("sync_mode") == "FULL")).alias("full_sync_count"),
        F.count_if(ok & (F.col("sync_mode") != "FULL")).alias("incremental_sync_count"),
        F.min("started_at").alias("_start"), F.max(ended).alias("_end"),
    )
    dur = (F.unix_micros(F.col("_end").cast("timestamp"))
           - F.unix_micros(F.col("_start").cast("timestamp"))) / F.lit(1e6)
    r = r.withColumn("total_duration_sec", dur).drop("_start", "_end")
    return r.withColumn(
        "rows_per_sec",
        F.when((F.col("total_records") > 0) & (F.col("total_duration_sec") > 0),
               F.col("total_records") / F.col("total_duration_sec")))


def database_subtotals(stats: DataFrame) -> DataFrame:
    """A-08: per database: rows of successful tables and wall duration."""
    ok = F.col("status") == "SUCCESS"
    ended = F.col("started_at") + F.make_dt_interval(secs=F.col("duration_sec"))
    g = stats.groupBy("database").agg(
        F.coalesce(F.sum(F.when(ok, F.col("records_synced"))), F.lit(0)).cast("bigint").alias("records"),
        F.count(F.lit(1)).alias("tables"),
        F.min("started_at").alias("_start"), F.max(ended).alias("_end"))
    dur = (F.unix_micros(F.col("_end").cast("timestamp"))
           - F.unix_micros(F.col("_start").cast("timestamp"))) / F.lit(1e6)
    return g.withColumn("duration_sec", dur).drop("_start", "_end")


# ---------------------------------------------------------------- A-11 / A-12
def change_volume(df: DataFrame, column: str, since: datetime | date | str) -> DataFrame:
    """A-11: number, earliest and latest of changes after ``since``."""
    dt = df.schema[column].dataType
    return (df.where(F.col(column) > bound_for(dt, since))
            .agg(F.count(F.lit(1)).alias("total_changes"),
                 F.min(column).alias("earliest_change"),
                 F.max(column).alias("latest_change")))


def changes_per_hour(df: DataFrame, column: str, since: datetime | date | str) -> DataFrame:
    """A-12: change count per hour bucket (text ``yyyy-MM-dd HH:00:00``)."""
    dt = df.schema[column].dataType
    return (df.where(F.col(column) > bound_for(dt, since))
            .groupBy(F.date_format(column, "yyyy-MM-dd HH:00:00").alias("hour_bucket"))
            .agg(F.count(F.lit(1)).alias("change_count"))
            .orderBy("hour_bucket"))


# ---------------------------------------------------------------- A-13
def append_outcome(target: DataFrame, source: DataFrame, hash_col: str = "data_hash",
                   tenant_col: str = TENANT) -> DataFrame:
    """A-13: per tenant and in total (``is_total``; its tenant is NULL): source
    rows, new rows (hash absent from the target) and duplicates."""
    return outcome_of_flags(flag_present(target, source, hash_col, tenant_col), tenant_col)


def flag_present(target: DataFrame, source: DataFrame, hash_col: str = "data_hash",
                 tenant_col: str = TENANT) -> DataFrame:
    """Source rows with ``_dup`` = True when their (tenant, hash) is already
    in the target.  The target side is made distinct first, so the left join
    never multiplies source rows."""
    have = (target.where(F.col(hash_col).isNotNull()).select(tenant_col, hash_col)
            .distinct().withColumn("_dup", F.lit(True)))
    have = have.withColumnsRenamed({tenant_col: "_have_tenant", hash_col: "_have_hash"})
    same = ((F.col(hash_col) == F.col("_have_hash"))
            & F.col(tenant_col).eqNullSafe(F.col("_have_tenant")))
    return (source.join(have, same, "left").drop("_have_tenant", "_have_hash")
            .withColumn("_dup", F.coalesce(F.col("_dup"), F.lit(False))))


def outcome_of_flags(flagged: DataFrame, tenant_col: str = TENANT) -> DataFrame:
    dup = F.col("_dup")
    return (flagged.rollup(tenant_col)
            .agg((F.grouping(tenant_col) == 1).alias("is_total"),
                 F.count(F.lit(1)).alias("source_rows"),
                 F.count_if(~dup).alias("new_rows"),
                 F.count_if(dup).alias("duplicate_rows")))


# ---------------------------------------------------------------- A-16
def _any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(f"`{k}`").isNull()
    return out


def _compared(source: DataFrame, target: DataFrame, keys: Sequence[str], tenant_col: str,
              compare: Sequence[str] | None) -> tuple[list[str], list[str]]:
    """The keys with the tenant, and the columns to compare."""
    ks = list(keys) + ([tenant_col] if tenant_col not in keys else [])
    cols = list(compare) if compare is not None else [
        c for c in source.columns if c in set(target.columns) and c not in SYSTEM_COLUMNS]
    return ks, cols


def _digest(p: str = "") -> list[Column]:
    """Count, sum and xor of row hashes ``_h``: the same in any order."""
    return [F.count(F.lit(1)).alias(f"{p}n"), F.sum(F.col("_h").cast("decimal(38,0)")).alias(f"{p}sum"),
            F.bit_xor("_h").alias(f"{p}xor")]


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str],
              tenant_col: str = TENANT, compare: Sequence[str] | None = None) -> DataFrame:
    """A-16: classify every key of source and target: ``missing`` (only in
    the source), ``extra`` (only in the target), ``changed`` (different
    content hash), ``same``; counts per tenant and class.

    Each side is first reduced to one row per (key, tenant) (count, sum and xor
    of the hashes, partial aggregation), then one 1:1 full outer join: a repeated key
    never emits pairs, no tenant becomes a single task, and rows without a
    key bypass the join (they count as missing or extra)."""
    ks, cols = _compared(source, target, keys, tenant_col, compare)
    keyed = _keyed_classes(_hashed(source, ks, cols), _hashed(target, ks, cols), ks, tenant_col)
    return _all_classes(keyed, source, target, ks, tenant_col)


def _hashed(df: DataFrame, ks: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys and ``_h``, a 64-bit fingerprint of the canonical row hash: fixed-width
    longs keep the aggregates HashAggregates.  Rows without a key are left out."""
    return df.where(~_any_null(ks)).select(*ks, F.xxhash64(row_hash(df, columns=cols)).alias("_h"))


def _keyed_classes(source: DataFrame, target: DataFrame, ks: Sequence[str], tenant_col: str) -> DataFrame:
    """Class counts of the keys of two hashed sides."""
    # one row per key and side (count, sum and xor of its rows' hashes, in
    # any order), so a key repeated many times is compared once
    j = source.groupBy(*ks).agg(*_digest("s")).join(target.groupBy(*ks).agg(*_digest("t")), list(ks), "full_outer")
    status = (F.when(F.col("tn").isNull(), F.lit("missing"))
              .when(F.col("sn").isNull(), F.lit("extra"))
              .when((F.col("sn") != F.col("tn")) | (F.col("ssum") != F.col("tsum"))
                    | (F.col("sxor") != F.col("txor")), F.lit("changed"))
              .otherwise(F.lit("same")))
    weight = F.greatest(F.coalesce("sn", F.lit(0)), F.coalesce("tn", F.lit(0)))
    return j.groupBy(tenant_col, status.alias("status")).agg(F.sum(weight).alias("row_count"))


def _all_classes(keyed: DataFrame, source: DataFrame, target: DataFrame, ks: Sequence[str],
                 tenant_col: str) -> DataFrame:
    """With the rows without a key, which can't be matched: missing (source) or
    extra (target)."""
    nulls = _any_null(ks)
    unkeyed = (source.where(nulls).select(tenant_col, F.lit("missing").alias("status"))
               .unionByName(target.where(nulls).select(tenant_col, F.lit("extra").alias("status")))
               .groupBy(tenant_col, "status").agg(F.count(F.lit(1)).alias("row_count")))
    return (keyed.unionByName(unkeyed).groupBy(tenant_col, "status")
            .agg(F.sum("row_count").cast("bigint").alias("row_count")))


TREE_LEVELS = (4, 8, 12)        # bits of the key's hash that a node of each level fixes


def digest_tree(hashed: DataFrame, ks: Sequence[str], tenant_col: str = TENANT,
                levels: Sequence[int] = TREE_LEVELS) -> DataFrame:
    """A tree of order-free digests per tenant over the ranges of the key's hash:
    level 0 is the whole tenant, level i has a node for each value of the first
    ``levels[i - 1]`` bits.  Only the finest level is computed from rows (a row a
    task and node goes through the shuffle); each level above sums the one below.
    Columns: tenant, ``level``, ``node``, ``n``, ``sum``, ``xor``."""
    finest = levels[-1]
    leaf = F.shiftrightunsigned(F.xxhash64(*ks), 64 - finest)
    from ..sinks.writers import stage
    # with the key, so that two keys that swap their rows differ; written down,
    # so the levels above read leaves and not the rows again
    rows = stage(hashed.select(tenant_col, leaf.alias("node"), F.xxhash64(*ks, "_h").alias("_h"))
                 .groupBy(tenant_col, "node").agg(*_digest()), "digest-leaves")
    tree = rows.select(tenant_col, F.lit(len(levels)).alias("level"), "node", "n", "sum", "xor")
    for i in range(len(levels) - 1, -1, -1):
        bits = levels[i - 1] if i else 0
        node = F.shiftrightunsigned("node", finest - bits) if i else F.lit(0).cast("bigint")
        above = (rows.select(tenant_col, node.alias("node"), "n", "sum", "xor").groupBy(tenant_col, "node")
                 .agg(F.sum("n").alias("n"), F.sum("sum").cast("decimal(38,0)").alias("sum"),
                      F.bit_xor("xor").alias("xor")))
        tree = tree.unionByName(above.select(tenant_col, F.lit(i).alias("level"), "node", "n", "sum", "xor"))
    return tree


def differing_ranges(source_tree: DataFrame, target_tree: DataFrame, tenant_col: str = TENANT,
                     levels: Sequence[int] = TREE_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Descend two trees from the roots: a node is looked at only if the node
    above differs.  Returns the finest ranges that differ (tenant, ``node``) and
    the rows per tenant in the nodes found equal (tenant, ``row_count``)."""
    from ..sinks.writers import stage
    open_nodes = equal = None
    for level in range(len(levels) + 1):
        bits = levels[level - 1] if level else 0
        s = source_tree.where(F.col("level") == level).drop("level")
        t = target_tree.where(F.col("level") == level).drop("level").withColumnsRenamed(
            {"n": "tn", "sum": "tsum", "xor": "txor"})
        if open_nodes is not None:
            up = levels[level - 2] if level > 1 else 0
            above = F.shiftrightunsigned("node", bits - up).alias("_up")
            parents = open_nodes.withColumnRenamed("node", "_up")
            s = s.withColumn("_up", above).join(parents, [tenant_col, "_up"], "left_semi").drop("_up")
            t = t.withColumn("_up", above).join(parents, [tenant_col, "_up"], "left_semi").drop("_up")
        j = s.join(t, [tenant_col, "node"], "full_outer")
        same = (F.col("n") == F.col("tn")) & (F.col("sum") == F.col("tsum")) & (F.col("xor") == F.col("txor"))
        # written down: the next level reads it three times
        j = stage(j.select(tenant_col, "node", "n", F.coalesce(same, F.lit(False)).alias("_same")), "digest-level")
        here = j.where("_same").select(tenant_col, F.col("n").alias("row_count"))
        equal = here if equal is None else equal.unionByName(here)
        open_nodes = j.where("not _same").select(tenant_col, "node")
    return open_nodes, equal.groupBy(tenant_col).agg(F.sum("row_count").alias("row_count"))


def rows_in_ranges(hashed: DataFrame, ranges: DataFrame, ks: Sequence[str], tenant_col: str = TENANT,
                   levels: Sequence[int] = TREE_LEVELS) -> DataFrame:
    """The hashed rows whose key falls into one of the ranges.  The tenants that
    have any are a literal filter (partition pruning on a table partitioned by
    tenant), so an equal tenant is not read again."""
    tenants = [r[0] for r in ranges.select(tenant_col).distinct().collect()]
    if not tenants:
        return hashed.limit(0)
    leaf = F.shiftrightunsigned(F.xxhash64(*ks), 64 - levels[-1])
    return (hashed.where(F.col(tenant_col).isin(tenants)).withColumn("node", leaf)
            .join(ranges, [tenant_col, "node"], "left_semi").drop("node"))


def reconcile_tree(source: DataFrame, target: DataFrame, keys: Sequence[str], tenant_col: str = TENANT,
                   compare: Sequence[str] | None = None, levels: Sequence[int] = TREE_LEVELS) -> DataFrame:
    """A-16 for sides that are mostly equal: the result of :func:`reconcile`, by a
    tree of digests.  Both trees (at most ``2 ** levels[-1]`` leaves a tenant) are
    written down and descended; only rows in ranges that differ are compared key by
    key.  Equal ranges, and so equal tenants, send no row through a join."""
    ks, cols = _compared(source, target, keys, tenant_col, compare)
    hashed_s, hashed_t = _hashed(source, ks, cols), _hashed(target, ks, cols)
    from ..sinks.writers import stage
    trees = [digest_tree(h, ks, tenant_col, levels) for h in (hashed_s, hashed_t)]
    ranges, equal = differing_ranges(*trees, tenant_col, levels)
    ranges = stage(ranges, "digest-ranges")
    apart = _keyed_classes(rows_in_ranges(hashed_s, ranges, ks, tenant_col, levels),
                           rows_in_ranges(hashed_t, ranges, ks, tenant_col, levels), ks, tenant_col)
    keyed = apart.unionByName(equal.select(tenant_col, F.lit("same").alias("status"), "row_count"))
    return _all_classes(keyed, source, target, ks, tenant_col)
