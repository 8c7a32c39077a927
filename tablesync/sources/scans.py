"""Scans: full, incremental windows, lookback, bootstrap, paging, keyset.

All filters compare the raw watermark column with a literal of its own type,
so Catalyst pushes them into the Parquet scan (``PushedFilters``) or into the
JDBC ``WHERE`` clause; nothing wraps the column in a function.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutil import as_datetime, bound_for, minus, ts_lit
from ..session import checkpoint_root

TimeLike = datetime | date | str


def _dtype(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def _is_epoch(df: DataFrame, column: str) -> bool:
    return isinstance(_dtype(df, column), T.IntegralType)


# ---------------------------------------------------------------- SC-01
def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, predicates: Sequence[str] | None = None,
              fetch_size: int = 10000, one_task: bool = False) -> DataFrame:
    """Source table over JDBC, read in parallel slices.

    Either a numeric/date ``partition_column`` with bounds (Spark splits the
    range into ``num_partitions`` queries) or explicit ``predicates`` (one
    query per predicate, e.g. one per month from :func:`backfill_ranges`).
    Without either, one task reads the whole table: only with ``one_task``.
    """
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions or 8,
                               properties=props)
    if not one_task:
        raise ValueError("give partition_column or predicates, or one_task=True for a small table")
    return spark.read.jdbc(url, table, properties=props)


def full_scan(df: DataFrame) -> DataFrame:
    """SC-01: the whole table (``SELECT *``)."""
    return df


# ---------------------------------------------------------------- SC-02 / SC-03
def window_predicate(df: DataFrame, column: str, start: TimeLike, end: TimeLike | None) -> Column:
    """``start < column <= end`` with bounds typed like the column."""
    dt = _dtype(df, column)
    pred = F.col(column) > bound_for(dt, start)
    if end is not None:
        pred = pred & (F.col(column) <= bound_for(dt, end))
    return pred


def incremental_window(df: DataFrame, column: str, last_sync: TimeLike, now: TimeLike,
                       lookback_minutes: float = 10) -> DataFrame:
    """SC-02/SC-03: rows changed in ``(last_sync - lookback, now]``.

    Works for datetime columns and for epoch-second integer columns (bounds
    converted to epoch seconds, never the column)."""
    safe = minus(last_sync, minutes=lookback_minutes)
    return df.where(window_predicate(df, column, safe, now))


incremental_window_epoch = incremental_window


# ---------------------------------------------------------------- A-02 helper
def last_value_per_tenant(target: DataFrame, column: str, by: str = "tenant_id") -> DataFrame:
    """Newest watermark value per tenant in the target; 0 / NULL means none."""
    agg = target.groupBy(by).agg(F.max(column).alias("_last"))
    if _is_epoch(target, column):
        agg = agg.withColumn("_last", F.nullif(F.col("_last"), F.lit(0)))
    return agg.where(F.col("_last").isNotNull())


# ---------------------------------------------------------------- bounds per tenant
BOUND_GROUPS = 8        # scans or terms that per-tenant bounds become, at most
BROADCAST_TENANTS = 100_000
LISTED_TENANTS = 200    # tenants that a term names, at most


def _bound_groups(rows: list, groups: int) -> list[tuple]:
    """(lowest bound, tenants) of at most ``groups`` groups, oldest first: the
    sorted bounds are cut at their widest gaps, so a tenant far behind does not
    widen the others' window."""
    rows = sorted(rows, key=lambda r: r[1])
    gaps = sorted(range(1, len(rows)), key=lambda i: rows[i][1] - rows[i - 1][1], reverse=True)[:groups - 1]
    cuts = [0, *sorted(i for i in gaps if rows[i][1] != rows[i - 1][1]), len(rows)]
    return [(rows[a][1], [r[0] for r in rows[a:b]]) for a, b in zip(cuts, cuts[1:]) if b > a]


def _one_of(by: str, tenants: list) -> Column:
    named = F.col(by).isin([t for t in tenants if t is not None])
    return named | F.col(by).isNull() if None in tenants else named


def rows_after_bounds(source: DataFrame, bounds: DataFrame, column: str, bound_column: str, by: str = "tenant_id",
                      groups: int = BOUND_GROUPS, partitioned: bool = False) -> DataFrame:
    """Rows of ``source`` with ``column`` beyond their tenant's bound; tenants
    without one are left out, a NULL tenant is a tenant like any other.

    The bounds (one row a tenant: control data) come to the driver and become
    literals that reach the scan: a disjunction of few (tenants, bound) terms, the
    tenants named where they are the older ones; or, where the source is
    ``partitioned`` by tenant, one scan for each group of tenants, of its partitions
    and its bound.  The exact bound is then joined."""
    spark = source.sparkSession
    dt = _dtype(source, column)
    bound = F.col(bound_column)
    if isinstance(dt, T.IntegralType) and not isinstance(bounds.schema[bound_column].dataType, T.IntegralType):
        bound = F.unix_timestamp(bound)
    exact = bounds.where(bound.isNotNull()).select(F.col(by).alias("_by"), bound.alias("_bound"))
    rows = [(r[0], r[1]) for r in exact.collect()]
    if not rows:
        return source.limit(0)
    found = _bound_groups(rows, groups)

    def after(value) -> Column:
        return F.col(column) > (F.lit(value).cast(dt) if isinstance(value, int) else bound_for(dt, value))
    if partitioned:
        near = None
        for low, tenants in found:
            part = source.where(_one_of(by, tenants) & after(low))
            near = part if near is None else near.unionByName(part)
    else:
        terms = after(found[-1][0])
        for low, tenants in found[:-1]:
            terms = terms | ((_one_of(by, tenants) & after(low)) if len(tenants) <= LISTED_TENANTS else after(low))
        near = source.where(after(found[0][0]) & terms)
    local = spark.createDataFrame(rows, exact.schema)
    if len(rows) <= BROADCAST_TENANTS:
        local = F.broadcast(local)
    return (near.join(local, F.col(by).eqNullSafe(F.col("_by")) & (F.col(column) > F.col("_bound")))
            .select(*source.columns))


# ---------------------------------------------------------------- SC-04
def lookback_after(source: DataFrame, last: DataFrame, column: str, lookback_hours: float = 1,
                   by: str = "tenant_id", partitioned: bool = False) -> DataFrame:
    """Per tenant, rows newer than its ``_last`` minus the lookback."""
    if isinstance(last.schema["_last"].dataType, T.IntegralType):
        bound = F.col("_last") - F.lit(int(lookback_hours * 3600))
    else:
        bound = F.col("_last") - F.make_dt_interval(secs=F.lit(float(lookback_hours * 3600)))
    return rows_after_bounds(source, last.select(by, bound.alias("_start")), column, "_start", by,
                             partitioned=partitioned)


def lookback_scan(source: DataFrame, target: DataFrame, column: str,
                  lookback_hours: float = 1, by: str = "tenant_id",
                  target_column: str | None = None, partitioned: bool = False) -> DataFrame:
    """SC-04: per tenant, rows newer than (newest value in target - lookback).

    The per-tenant maximum is an aggregate with one row per tenant, whose
    bounds reach the scan (see :func:`rows_after_bounds`).
    Tenants without history are not returned (see :func:`bootstrap_recent`).
    """
    last = last_value_per_tenant(target, target_column or column, by)
    return lookback_after(source, last, column, lookback_hours, by, partitioned)


lookback_scan_epoch = lookback_scan


# ---------------------------------------------------------------- SC-05
def bootstrap_recent(df: DataFrame, column: str, now: TimeLike, hours: float = 24) -> DataFrame:
    """SC-05: first run without history: rows with ``column >= now - hours``."""
    start = minus(now, hours=hours)
    return df.where(F.col(column) >= bound_for(_dtype(df, column), start))


# ---------------------------------------------------------------- SC-06
def since_last_load(source: DataFrame, target: DataFrame, column: str,
                    load_column: str = "sync_timestamp") -> DataFrame:
    """SC-06: rows whose ``column`` is newer than the target's last load time.

    The maximum is a scalar subquery (evaluated once, shipped as a value);
    an empty target means "no history" and everything is read."""
    last = target.select(F.max(load_column)).scalar()
    if _is_epoch(source, column):
        last = F.unix_timestamp(last)
    else:
        last = last.cast(_dtype(source, column))
    return source.where(last.isNull() | (F.col(column) > last))


# ---------------------------------------------------------------- SC-07 / SC-08
def incremental_projected(df: DataFrame, column: str, columns: Sequence[str],
                          last_sync: TimeLike, now: TimeLike,
                          lookback_minutes: float = 10) -> DataFrame:
    """SC-07: the incremental window with an explicit column list (pruned
    down to the scan's ``ReadSchema``)."""
    return incremental_window(df, column, last_sync, now, lookback_minutes).select(*columns)


def incremental_created_only(df: DataFrame, column: str, last_sync: TimeLike) -> DataFrame:
    """SC-08: insert-only tables: ``created > last``, no lookback, no upper bound."""
    return df.where(window_predicate(df, column, last_sync, None))


# ---------------------------------------------------------------- SC-09
# Guide tiers: high-frequency tables look back 2 minutes, medium 10, low 30.
LOOKBACK_TIERS = ((2, "high"), (10, "medium"), (30, "low"))


def lookback_policy(history: DataFrame, column: str, by: str, since: TimeLike,
                    until: TimeLike, high_per_hour: float, medium_per_hour: float) -> DataFrame:
    """Lookback minutes per group from its change rate in ``(since, until]``."""
    hours = (as_datetime(until) - as_datetime(since)).total_seconds() / 3600.0
    rate = (history.where(window_predicate(history, column, since, until))
            .groupBy(by).agg((F.count(F.lit(1)) / F.lit(hours)).alias("changes_per_hour")))
    return rate.withColumn(
        "lookback_minutes",
        F.when(F.col("changes_per_hour") >= high_per_hour, F.lit(LOOKBACK_TIERS[0][0]))
        .when(F.col("changes_per_hour") >= medium_per_hour, F.lit(LOOKBACK_TIERS[1][0]))
        .otherwise(F.lit(LOOKBACK_TIERS[2][0])))


def incremental_tiered_lookback(df: DataFrame, column: str, policy: DataFrame, by: str,
                                last_sync: TimeLike, now: TimeLike,
                                default_minutes: int = 10) -> DataFrame:
    """SC-09: window whose lookback depends on the group's policy row.

    The static part of the predicate (widest lookback, upper bound) is
    applied first so the scan still prunes; the per-group bound follows the
    (small, per-group) policy join."""
    widest = max(m for m, _ in LOOKBACK_TIERS + ((default_minutes, ""),))
    pre = incremental_window(df, column, last_sync, now, widest)
    last = ts_lit(last_sync)
    minutes = F.coalesce(F.col("lookback_minutes"), F.lit(default_minutes))
    if _is_epoch(df, column):
        bound = F.unix_timestamp(last) - minutes * 60
    else:
        bound = last - F.make_dt_interval(mins=minutes)
    return (pre.join(policy.select(by, "lookback_minutes"), by, "left")
            .where(F.col(column) > bound))


# ---------------------------------------------------------------- SC-10 / S-04
def page(df: DataFrame, column: str, key: str, page_no: int, page_size: int) -> DataFrame:
    """One page ``ORDER BY column, key LIMIT n OFFSET k`` (key breaks ties so
    pages are stable).  Deep offsets are not scalable; use
    :func:`paged_scan` to label all pages in one pass."""
    return df.orderBy(column, key).offset(page_no * page_size).limit(page_size)


def paged_scan(df: DataFrame, column: str, key: str, page_size: int,
               num_slices: int | None = None) -> DataFrame:
    """SC-10: every row of the increment with its page number.

    Distributed global numbering: range-partition and sort on (column, key),
    count rows per slice, prefix-sum the (few) slice counts, and add each
    row's offset inside its slice.  No single-partition window."""
    spark = df.sparkSession
    n = num_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # slice id and in-slice position come from the physical partitioning, so
    # they are materialised once (reliable checkpoint in the shared folder)
    # before two branches read them; a recomputation could otherwise see a
    # different partition layout.
    checkpoint_root(spark)
    local = (df.repartitionByRange(n, column, key)
             .sortWithinPartitions(column, key)
             .withColumn("_slice", F.spark_partition_id())
             .withColumn("_pos", F.monotonically_increasing_id()
                         - F.shiftleft(F.col("_slice").cast("bigint"), 33))
             .checkpoint(eager=True))
    counts = local.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.withColumn(
        "_start", F.coalesce(F.sum("_n").over(
            Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per slice: bounded by the partition count, safe to broadcast
    out = local.join(F.broadcast(starts.select("_slice", "_start")), "_slice")
    return (out.withColumn("page_no", F.floor((F.col("_start") + F.col("_pos")) / page_size)
                           .cast("bigint"))
            .drop("_slice", "_pos", "_start"))


SLICES_PER_PAGE = 4     # sketch quantiles to a page: what of the rows is ranked exactly
MAX_SLICES = 20_000


def _slices(df: DataFrame, column: str, pages: int) -> list:
    """Approximate quantiles of the column (a mergeable sketch, one pass), sorted
    and distinct: the upper ends of slices; none for a column without values."""
    m = min(MAX_SLICES, max(2, pages * SLICES_PER_PAGE))
    found = df.agg(F.percentile_approx(column, [i / m for i in range(1, m)], 10 * m)).first()[0]
    return sorted(set(found or []))


def _slice_of(values: pa.ChunkedArray | pa.Array, ends: pa.Array) -> np.ndarray:
    return np.searchsorted(ends.to_numpy(zero_copy_only=False), values.to_numpy(zero_copy_only=False), side="left")


def page_bounds(df: DataFrame, column: str, key: str, page_size: int) -> DataFrame:
    """SC-10 without a shuffle of rows: per page of ``page_size`` rows in the order
    (column, key) its ``page_no``, its first row's column and key, and ``row_count``;
    pages are those of :func:`paged_scan`.  Rows need a column value.

    A quantile sketch cuts the column into slices; one pass counts their rows
    exactly.  A page begins in the slice that holds its first rank; only those
    slices' (column, key) pairs, about one in ``SLICES_PER_PAGE``, are ranked.  The
    pages are then independent reads (:func:`read_page`)."""
    spark = df.sparkSession
    slim = df.where(F.col(column).isNotNull()).select(F.col(column).alias("c"), F.col(key).alias("k"))
    n = slim.count()
    pages = -(-n // page_size)
    schema = f"page_no bigint, {column} {slim.schema['c'].dataType.simpleString()}, " \
             f"{key} {slim.schema['k'].dataType.simpleString()}, row_count bigint"
    if not n:
        return spark.createDataFrame([], schema)
    ends = _slices(slim, "c", pages)
    arrow_ends = pa.array(ends)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ends) + 1, np.int64)
        for b in batches:
            total += np.bincount(_slice_of(b.column(0), arrow_ends.cast(b.column(0).type)), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["s", "n"])
    counts = dict(slim.select("c").mapInArrow(count, "s bigint, n bigint").groupBy("s").agg(F.sum("n")).collect())
    # slices in which a page begins, and the rank that each starts at
    wanted, before = {}, 0
    for s in range(len(ends) + 1):
        own = counts.get(s, 0)
        if own and -(-before // page_size) * page_size < before + own:
            wanted[s] = before
        before += own

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.array(sorted(wanted))
        for b in batches:
            s = _slice_of(b.column(0), arrow_ends.cast(b.column(0).type))
            mask = np.isin(s, keep)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(mask)), b.column(1).filter(pa.array(mask)),
                                              pa.array(s[mask].astype(np.int64))], ["c", "k", "s"])
    types = f"c {slim.schema['c'].dataType.simpleString()}, k {slim.schema['k'].dataType.simpleString()}, s bigint"
    picked = paged_scan(slim.mapInArrow(pick, types), "c", "k", 1)      # page_no: the rank among what was picked
    first = picked.groupBy("s").agg(F.min("page_no").alias("first"))
    starts = spark.createDataFrame(sorted(wanted.items()), "s bigint, start bigint")
    rank = F.col("start") + F.col("page_no") - F.col("first")
    heads = (picked.join(F.broadcast(first.join(starts, "s")), "s").withColumn("rank", rank)
             .where(F.col("rank") % page_size == 0))
    page = (F.col("rank") / page_size).cast("bigint")
    return heads.select(page.alias("page_no"), F.col("c").alias(column), F.col("k").alias(key),
                        F.least(F.lit(page_size), F.lit(n) - F.col("rank")).cast("bigint").alias("row_count"))


def read_page(df: DataFrame, column: str, key: str, first: tuple, after: tuple | None) -> DataFrame:
    """The rows of one page: from its first (column, key) up to, without, the next
    page's.  The column's range reaches the scan as literals."""
    dt = _dtype(df, column)

    def lit(v) -> Column:
        return F.lit(v).cast(dt) if isinstance(v, int) else bound_for(dt, v)
    c, k = F.col(column), F.col(key)
    rows = df.where((c >= lit(first[0])) & ((c > lit(first[0])) | (k >= F.lit(first[1]))))
    if after is not None:
        rows = rows.where((c <= lit(after[0])) & ((c < lit(after[0])) | (k < F.lit(after[1]))))
    return rows


# ---------------------------------------------------------------- SC-11
def backfill_ranges(spark: SparkSession, start: TimeLike, end: TimeLike,
                    months: int = 1) -> DataFrame:
    """Month chunks ``[chunk_start, chunk_end)`` covering ``[start, end)``."""
    s, e = as_datetime(start).date(), as_datetime(end).date()
    return (spark.range(1)
            .select(F.explode(F.sequence(F.trunc(F.lit(s), "MM"), F.lit(e),
                                         F.expr(f"INTERVAL {months} MONTH"))).alias("chunk_start"))
            .where(F.col("chunk_start") < F.lit(e))
            .withColumn("chunk_end", F.add_months("chunk_start", months)))


def range_backfill(df: DataFrame, column: str, start: TimeLike, end: TimeLike) -> DataFrame:
    """SC-11: rows in ``[start, end)`` tagged with their month chunk.

    The range filter reaches the scan; the chunk is the month of the value,
    the same rows a loop of monthly ``>= chunk AND < next`` reads returns."""
    dt = _dtype(df, column)
    rows = df.where((F.col(column) >= bound_for(dt, start)) & (F.col(column) < bound_for(dt, end)))
    col = F.col(column)
    if isinstance(dt, T.IntegralType):
        col = F.timestamp_seconds(col).cast("timestamp_ntz")
    return rows.withColumn("backfill_month", F.trunc(col.cast("date"), "MM"))


# ---------------------------------------------------------------- SC-12 / S-02
def keyset_scan(df: DataFrame, column: str, key: str, last_value: TimeLike,
                last_key, page_size: int | None = None) -> DataFrame:
    """SC-12: rows after the composite watermark ``(last_value, last_key)``.

    ``column > w OR (column = w AND key > k)``; ordered by (column, key);
    ``page_size`` gives the next page only."""
    dt = _dtype(df, column)
    w = bound_for(dt, last_value)
    out = df.where((F.col(column) > w) | ((F.col(column) == w) & (F.col(key) > F.lit(last_key))))
    out = out.orderBy(column, key)
    return out.limit(page_size) if page_size else out


# ---------------------------------------------------------------- S-01 / S-03
def ordered_increment(df: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """S-01: the increment in watermark order (global sort, range-partitioned)."""
    return df.orderBy(*([column] + ([key] if key else [])))


def capped_increment(df: DataFrame, column: str, key: str, cap: int) -> DataFrame:
    """S-03: the first ``cap`` rows of the increment (``TakeOrderedAndProject``)."""
    return df.orderBy(column, key).limit(cap)
