"""ST-01: the scheduled incremental upsert as a Structured Streaming query.

New increment files arrive under an input folder; each micro-batch is merged
into the target on key + tenant (J-01) by ``foreachBatch``.  The stream's
checkpoint (in the shared checkpoint folder) replaces the watermark file: a
restarted query resumes after the last committed batch, and a batch that is
re-run after a failure merges the same rows again, which changes nothing.
``stream_upsert_distinct`` removes repeated deliveries in bounded state first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import any_null, one_per_key
from ..sinks.writers import existing_schema, merge_into_table, read_table, staging
from ..session import scratch_path


def upsert_batch(target_path: str, keys: Sequence[str], latest_by: str | None,
                 bucket: Column | None = None):
    """The ``foreachBatch`` function: reduce the batch to one row per key
    and merge it into the target (staged, tenant- or bucket-scoped overwrite)."""
    def _fn(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        merge_into_table(batch, target_path, keys, latest_by=latest_by, bucket=bucket)
    return _fn


def distinct_versions(stream: DataFrame, keys: Sequence[str], event_time: str, version: str,
                      delay: str, tenant_col: str = "tenant_id") -> DataFrame:
    """The stream without repeated deliveries: the first of each (key, tenant,
    version) within ``delay`` of event time.  The state holds the identities seen
    in that time only; the watermark removes older ones."""
    # watermarks are for zoned timestamps; the session's zone is UTC
    return (stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
            .withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark([*keys, tenant_col, version]).drop("_event_time"))


def stream_upsert_distinct(spark: SparkSession, input_path: str, schema: T.StructType, target_path: str,
                           keys: Sequence[str], event_time: str, version: str, delay: str = "1 hour",
                           checkpoint: str | None = None, files_per_batch: int | None = None,
                           tenant_col: str = "tenant_id") -> dict[str, int]:
    """ST-01 for a source that delivers rows again and again: rows go through
    stateful duplicate removal, keyed by key, tenant and version, before they
    are merged, so a repeated delivery costs no rewrite of its partition.

    The watermark lets Spark drop rows later than ``delay``; they take a second
    path: if the state operator says that it dropped any, the run ends with one
    batch merge of the input against the target, which takes only versions newer
    than the target's.  So a late row is not lost, and a late older version
    changes nothing.  Rows with a NULL key match nothing; the stream's path
    inserts them once.

    Returns numbers of rows: ``merged`` through the stream, ``late`` through the
    second path, and ``state`` (identities still held at the end)."""
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    counts = {"merged": 0, "late": 0, "state": 0}

    def merge(batch: DataFrame, batch_id: int) -> None:
        counts["merged"] += _merge_versions(batch, target_path, keys, version, tenant_col)
    q = (distinct_versions(reader.parquet(input_path), keys, event_time, version, delay, tenant_col)
         .writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    # progress is kept of the last batches only; of a longer run it is not known
    dropped = int(bool(q.recentProgress) and q.recentProgress[0]["batchId"] > 0)
    for p in q.recentProgress:
        for op in p["stateOperators"]:
            dropped += op["numRowsDroppedByWatermark"]
            counts["state"] = op["numRowsTotal"]
    if dropped:
        again = spark.read.schema(schema).parquet(input_path).where(~any_null([*keys, tenant_col]))
        counts["late"] = _merge_versions(again, target_path, keys, version, tenant_col)
    return counts


def _merge_versions(rows: DataFrame, target_path: str, keys: Sequence[str], version: str, tenant_col: str) -> int:
    """Merge the rows that are newer than the target's version of their key;
    returns how many that were."""
    spark = rows.sparkSession
    newest = one_per_key(rows, [*keys, tenant_col], version)
    with staging() as put:
        if existing_schema(spark, target_path) is not None:
            have = read_table(spark, target_path).select(*[F.col(k).alias(f"_{k}") for k in (*keys, tenant_col)],
                                                         F.col(version).alias("_have"))
            same = F.lit(True)
            for k in (*keys, tenant_col):
                same = same & (F.col(k) == F.col(f"_{k}"))
            newest = newest.join(have, same & (F.col("_have") >= F.col(version)), "left_anti")
        staged = put(newest, "stream-new")
        n = staged.count()
        if n:
            merge_into_table(staged, target_path, keys, latest_by=version)
    return n


def stream_upsert(spark: SparkSession, input_path: str, schema: T.StructType, target_path: str,
                  keys: Sequence[str], latest_by: str | None = None,
                  checkpoint: str | None = None, files_per_batch: int | None = None,
                  bucket: Column | None = None) -> None:
    """Run the upsert stream over everything available now, then stop.

    Rows delivered twice, and older versions of a row, are reduced to the newest
    by ``latest_by`` in each batch (W-05); late rows are merged, never dropped.

    ``files_per_batch``: optional cap on files per micro-batch; by default a
    batch takes every file available (few large merges instead of one merge,
    i.e. one partition rewrite, per file)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(input_path)
    q = (stream.writeStream
         .foreachBatch(upsert_batch(target_path, keys, latest_by, bucket))
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
