"""Sinks on plain Parquet tables (a path, shared by all tenants).

Layout: mutable targets are partitioned by ``tenant_id`` only, so a tenant
can be replaced by dynamic partition overwrite without touching the others;
append-only targets may add ``sync_date``.  Writer tasks are sized by
``REBALANCE``, so a tenant holding a third of the rows is written by many, and
rows are sorted by the watermark for row-group pruning.

Every rewrite of a table that is also read goes through a staged copy under
the shared checkpoint folder (SK-06), released when the write has ended.  While
partitions are replaced from a copy, a record in the table's ``_tablesync``
folder (hidden from scans) says from which; :func:`recover` finishes what was
interrupted.  The same folder keeps the schema a table was created with and the
columns its row hash covers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_columns, row_hash, with_row_hash
from ..operators.merge import merge_on_key, one_per_key
from ..operators.transform import align_to_target
from ..session import path_exists, scratch_path

TENANT = "tenant_id"


class TargetNotEmpty(RuntimeError):
    """Raised by :func:`write_if_empty` when the target already has rows."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


# ---------------------------------------------------------------- table notes
NOTES = "_tablesync"


def _note_path(spark: SparkSession, path: str, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{NOTES}/{name}.json")


def put_note(spark: SparkSession, path: str, name: str, value) -> None:
    """Keep a small JSON value with the table (written aside, then renamed)."""
    fs, _ = _fs(spark, path)
    target, aside = _note_path(spark, path, name), _note_path(spark, path, f".{name}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(aside, target)


def get_note(spark: SparkSession, path: str, name: str):
    """The value kept under ``name``, or None."""
    fs, _ = _fs(spark, path)
    target = _note_path(spark, path, name)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def drop_note(spark: SparkSession, path: str, name: str) -> None:
    fs, _ = _fs(spark, path)
    fs.delete(_note_path(spark, path, name), False)


def notes(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the notes that begin with ``prefix``."""
    fs, _ = _fs(spark, path)
    folder = _note_path(spark, path, "x").getParent()
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    return sorted(n.removesuffix(".json") for n in names if n.startswith(prefix) and n.endswith(".json"))


def _ensure_dynamic(spark: SparkSession) -> None:
    """Static overwrite of a staged result would delete every other tenant."""
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    if mode.lower() != "dynamic":
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def layout(df: DataFrame, partition_cols: Sequence[str], sort_col: str | None = None) -> DataFrame:
    """Rows to writer tasks by partition value, sized at run time: the
    ``REBALANCE`` hint shuffles on the partition columns and lets AQE split a
    partition value larger than ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    over several tasks (a tenant holding a third of all rows is written in
    parallel, in files of about that size) and coalesce small ones (a small
    tenant is one file).  Sizes come from the shuffle's own statistics: no
    counting pass over the data."""
    if not partition_cols:
        return df
    pc = list(partition_cols)
    out = df.hint("rebalance", *pc)
    if sort_col:
        out = out.sortWithinPartitions(*pc, sort_col)
    return out


def touched_tenants(df: DataFrame, col: str = TENANT) -> list:
    """Distinct tenants present in ``df``: a list bounded by the number of
    tenants (metadata), used for static partition pruning of the target."""
    return [r[0] for r in df.select(col).distinct().collect()]


def prune_to_tenants(target: DataFrame, tenants: list, col: str = TENANT) -> DataFrame:
    """Partition filter on the target's tenant column (``PartitionFilters``);
    NULL is a tenant like any other."""
    if not tenants:
        return target.limit(0)
    return target.where(_among(col, tenants))


def _among(col: str, values: list) -> Column:
    some = F.col(col).isin([v for v in values if v is not None])
    return some | F.col(col).isNull() if None in values else some


def existing_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of the table at ``path``: of its data files, or the one it was
    created with (:func:`ensure_target`) while it has none.  None when there is
    no table; any other fault of the table is raised."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as exc:
        if (exc.getCondition() or "").startswith("UNABLE_TO_INFER_SCHEMA"):
            kept = get_note(spark, path, "schema")
            return T.StructType.fromJson(kept) if kept else None
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table, also while it has no data file."""
    schema = existing_schema(spark, path)
    return (spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path))


def is_empty(spark: SparkSession, path: str) -> bool:
    return existing_schema(spark, path) is None or read_table(spark, path).isEmpty()


# ---------------------------------------------------------------- SK-01 / SK-02
def write_truncate(df: DataFrame, path: str, partition_cols: Sequence[str] = (),
                   sort_col: str | None = None) -> None:
    """SK-01: replace the whole table (all tenants)."""
    w = layout(df, partition_cols, sort_col).write.mode("overwrite")
    if partition_cols:
        w = w.option("partitionOverwriteMode", "static").partitionBy(*partition_cols)
    w.parquet(path)


def write_append(df: DataFrame, path: str, partition_cols: Sequence[str] = (),
                 sort_col: str | None = None) -> None:
    """SK-02: append; when the table exists the rows are aligned to its
    schema first (a column mismatch would fail or misplace values)."""
    spark = df.sparkSession
    schema = existing_schema(spark, path)
    if schema is not None:
        df = align_to_target(df, schema)
    w = layout(df, partition_cols, sort_col).write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


# ---------------------------------------------------------------- SK-03
def write_if_empty(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """SK-03: write only if the target has no rows (an existing empty table
    is fine, unlike ``errorifexists``)."""
    spark = df.sparkSession
    if not is_empty(spark, path):
        raise TargetNotEmpty(path)
    write_append(df, path, partition_cols)


# ---------------------------------------------------------------- SK-04
def ensure_target(spark: SparkSession, path: str, schema: T.StructType,
                  partition_cols: Sequence[str] = (TENANT,)) -> None:
    """SK-04: create the (empty) partitioned table if it does not exist.  The
    schema is kept with it: what is written later is aligned to it."""
    if existing_schema(spark, path) is not None:
        return
    empty = spark.createDataFrame([], schema)
    w = empty.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    # partition columns come last when a table is read
    last = [f for f in schema.fields if f.name in partition_cols]
    put_note(spark, path, "schema", T.StructType([f for f in schema.fields if f not in last] + last).jsonValue())


def with_sync_date(df: DataFrame, column: str = "sync_timestamp") -> DataFrame:
    """Derived day partition for append-only targets."""
    return df.withColumn("sync_date", F.to_date(column))


# ---------------------------------------------------------------- SK-05
def drop_tenant_partitions(spark: SparkSession, path: str, tenants: Sequence[str]) -> None:
    """Remove whole tenant partitions (used when a replacement is empty)."""
    fs, _ = _fs(spark, path)
    for t in tenants:
        p = _partition_path(spark, path, TENANT, t)
        if fs.exists(p):
            fs.delete(p, True)


def _partition_path(spark: SparkSession, path: str, col: str, value):
    """The folder Spark gives a partition value (escaped; NULL has its own),
    which is always a child of ``path``."""
    _, root = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    utils = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    p = jvm.org.apache.hadoop.fs.Path(root, utils.getPartitionPathString(col, value))
    if p.getParent() is None or p.getParent().toString() != root.toString():
        raise ValueError(f"partition {col}={value!r} is no folder of {path}")
    return p


def _partition_value(spark: SparkSession, name: str):
    """The value of a partition folder's name."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    value = name.split("=", 1)[1]
    return None if value == utils.DEFAULT_PARTITION_NAME() else utils.unescapePathName(value)


def prune_to_pairs(target: DataFrame, changes: DataFrame, bucket_col: str) -> DataFrame:
    """Target rows of the (tenant, bucket) partitions present in ``changes``:
    static partition filters on both columns (a superset), then an exact
    semi-join on the pairs (distributed; AQE broadcasts it when small).
    The driver sees only the distinct tenants and the distinct buckets, each
    bounded by its own count, never their product."""
    pairs = changes.select(TENANT, bucket_col).distinct()
    t = prune_to_tenants(target, touched_tenants(pairs))
    t = prune_to_tenants(t, touched_tenants(pairs, bucket_col), bucket_col)
    pairs = pairs.select(F.col(TENANT).alias("_pair_tenant"), F.col(bucket_col).alias("_pair_bucket"))
    return t.join(pairs, F.col(TENANT).eqNullSafe(F.col("_pair_tenant"))
                  & F.col(bucket_col).eqNullSafe(F.col("_pair_bucket")), "left_semi")


def drop_stale_buckets(spark: SparkSession, path: str, tenants: Sequence[str],
                       written: set, bucket_col: str) -> None:
    """After a FULL replacement of ``tenants`` in a bucketed table, remove
    the bucket partitions those tenants had before and no longer have."""
    fs, _ = _fs(spark, path)
    for t in tenants:
        tdir = _partition_path(spark, path, TENANT, t)
        if not fs.exists(tdir):
            continue
        for st in fs.listStatus(tdir):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(f"{bucket_col}="):
                if (t, _partition_value(spark, name)) not in written:
                    fs.delete(st.getPath(), True)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str] = (TENANT,),
                         sort_col: str | None = None) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are
    replaced; all others stay as they are."""
    _ensure_dynamic(df.sparkSession)
    (layout(df, partition_cols, sort_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path))


def stage(df: DataFrame, name: str) -> DataFrame:
    """SK-06: materialise ``df`` under the shared checkpoint folder and return
    the staged copy (cuts lineage; the staged files outlive executor loss).
    Drop it with :func:`release` once the final write has committed; a copy
    that could not be written whole is dropped here."""
    spark = df.sparkSession
    p = scratch_path(spark, name)
    try:
        df.write.mode("overwrite").parquet(p)
    except Exception:
        fs, root = _fs(spark, p)
        fs.delete(root, True)
        raise
    out = spark.read.schema(df.schema).parquet(p)
    out._staged_at = p
    return out


def release(*staged: DataFrame | None) -> None:
    """Delete staged copies (what :func:`stage` returned) once the write that
    consumed them has ended, so merges do not leave a copy of every increment
    in the shared folder.  A copy that an unfinished replacement still needs
    stays for :func:`recover`."""
    for df in staged:
        if root := getattr(df, "_staged_at", None):
            if not getattr(df, "_recorded", False):
                fs, p = _fs(df.sparkSession, root)
                fs.delete(p, True)


@contextmanager
def staging() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """:func:`stage` for the length of a block: its copies are released when
    the block ends, whatever happens."""
    held: list[DataFrame] = []

    def put(df: DataFrame, name: str) -> DataFrame:
        held.append(stage(df, name))
        return held[-1]
    try:
        yield put
    finally:
        release(*held)


def replace_partitions(staged: DataFrame, path: str, partition_cols: Sequence[str] = (TENANT,),
                       sort_col: str | None = None, empty: Sequence[str] = ()) -> None:
    """Replace the partitions present in a staged copy and remove those of the
    tenants in ``empty``.  Spark moves partitions in one by one; a record of the
    copy is kept until all are in, so that :func:`recover` can finish."""
    spark = staged.sparkSession
    name = f"replace-{uuid.uuid4().hex}"
    put_note(spark, path, name, {"copy": staged._staged_at, "schema": staged.schema.jsonValue(),
                                 "partitions": list(partition_cols), "sort": sort_col, "empty": list(empty)})
    staged._recorded = True
    overwrite_partitions(staged, path, partition_cols, sort_col)
    drop_tenant_partitions(spark, path, empty)
    drop_note(spark, path, name)
    staged._recorded = False


def recover(spark: SparkSession, path: str) -> int:
    """Finish replacements of ``path`` that were interrupted: the copy is
    written again (the same partitions, so repeating is harmless), then it and
    its record go.  Returns how many there were.  Every pipeline calls this
    before it reads its target."""
    found = notes(spark, path, "replace-") if path_exists(spark, path) else []
    for name in found:
        record = get_note(spark, path, name)
        if path_exists(spark, record["copy"]):
            copy = spark.read.schema(T.StructType.fromJson(record["schema"])).parquet(record["copy"])
            overwrite_partitions(copy, path, record["partitions"], record["sort"])
            drop_tenant_partitions(spark, path, record["empty"])
            copy._staged_at = record["copy"]
            release(copy)
        drop_note(spark, path, name)
    return len(found)


# ---------------------------------------------------------------- PR-10 on a table
def hash_columns_of(spark: SparkSession, path: str, schema: T.StructType) -> list[str]:
    """The columns that the stored row hashes cover: those recorded when the
    table got its hash, else all data columns of its schema."""
    kept = get_note(spark, path, "hash_columns")
    names = set(schema.fieldNames())
    return [c for c in kept if c in names] if kept else hash_columns(spark.createDataFrame([], schema))


def record_hash_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    put_note(spark, path, "hash_columns", sorted(columns))


def comparable_hashes(target: DataFrame, source: DataFrame, given: Sequence[str], covered: Sequence[str],
                      hash_col: str = "data_hash") -> tuple[DataFrame, DataFrame, str]:
    """Both sides with a hash that can be compared, and its name.

    ``source`` is aligned to the target and hashed over ``covered``, the
    columns the stored hash covers; ``given`` are the columns it brought along.
    If it brought them all, the stored hash serves.  Else both sides are hashed
    again over the columns that they share (``_shared_hash``)."""
    shared = [c for c in covered if c in set(given) | {TENANT}]
    if set(shared) <= {TENANT}:
        raise ValueError("source and target share no data column")
    source = source.withColumn(hash_col, row_hash(source, columns=covered))
    if len(shared) == len(covered):
        return target, source, hash_col
    return (target.withColumn("_shared_hash", row_hash(target, columns=shared)),
            source.withColumn("_shared_hash", row_hash(source, columns=shared)), "_shared_hash")


def replace_tenant(source: DataFrame, path: str, tenants: Sequence[str] | None = None,
                   sort_col: str | None = None) -> None:
    """SK-05: replace the rows of the source's tenants (or of ``tenants``),
    leave all other tenants untouched; a tenant named in ``tenants`` with no
    source rows is emptied (not left stale)."""
    spark = source.sparkSession
    schema = existing_schema(spark, path)
    if schema is not None:
        source = align_to_target(source, schema)
    if tenants is not None:
        source = source.where(_among(TENANT, list(tenants)))
    recover(spark, path)
    with staging() as put:
        staged = put(source, "replace")
        present = set(touched_tenants(staged)) if tenants is not None else set()
        replace_partitions(staged, path, (TENANT,), sort_col, [t for t in tenants or () if t not in present])


# ---------------------------------------------------------------- J-01 on a table
def merge_into_table(source: DataFrame, path: str, keys: Sequence[str],
                     latest_by: str | None = None, sort_col: str | None = None,
                     bucket: Column | None = None, bucket_col: str = "key_bucket") -> None:
    """J-01 applied to a stored table.  Only the tenants present in the
    source are read (static ``PartitionFilters``) and rewritten; the merged
    result is staged, then overwrites exactly those partitions.  Repeating
    the call gives the same table (idempotent).

    ``bucket``: an expression of the merge key alone (e.g. ``floor(id / 1e6)``
    for growing ids, ``pmod(xxhash64(id), 1024)`` otherwise) adds a second
    partition level.  A key's bucket never changes, so only the
    (tenant, bucket) partitions the increment touches are read and
    rewritten: a tenant holding a third of the table is not rewritten whole
    for a small increment."""
    spark = source.sparkSession
    parts = (TENANT,) if bucket is None else (TENANT, bucket_col)
    if bucket is not None:
        source = source.withColumn(bucket_col, bucket.cast("string"))
    if existing_schema(spark, path) is None:
        first = one_per_key(source, list(keys) + [TENANT], latest_by)
        overwrite_partitions(first, path, parts, sort_col)
        return
    recover(spark, path)
    target = read_table(spark, path)
    with staging() as put:
        src = put(align_to_target(source, target.schema), "merge-src")
        if bucket is None:
            t = prune_to_tenants(target, touched_tenants(src))
        else:
            t = prune_to_pairs(target, src, bucket_col)
        merged = put(merge_on_key(t, src, keys, latest_by=latest_by), "merge")
        replace_partitions(merged, path, parts, sort_col)


# ---------------------------------------------------------------- SK-07
def rebuild_with_hash(spark: SparkSession, path: str, backup_path: str | None = None,
                      hash_col: str = "data_hash") -> str | None:
    """SK-07: if the target lacks the hash column, back it up and rewrite it
    *with* the hash computed (other tenants' rows are kept).  Returns the
    backup's path, None when there was nothing to do."""
    target = read_table(spark, path)
    if hash_col in target.columns:
        return None
    backup = backup_path or scratch_path(spark, "backup")
    target.write.mode("overwrite").parquet(backup)
    rebuilt = with_row_hash(spark.read.parquet(backup), hash_col)
    parts = [TENANT] if TENANT in target.columns else []
    w = layout(rebuilt, parts).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
    record_hash_columns(spark, path, hash_columns(target))
    return backup
