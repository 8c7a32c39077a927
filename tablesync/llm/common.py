"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesync.session import scratch_path

# A set of keys is broadcast only up to this many rows (about 30 MB);
# beyond it the same join shuffles.
BROADCAST_ROWS = 500_000
LEAST_PARTS = 12
ARROW_ROWS = 500
ARROW_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, parts: int | None = None, **options) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, from at
    most ``parts`` tasks (see ``parts_for``), so few rows are few files.
    ``options`` are the writer's.

    Cuts the lineage: what follows reads files that every executor sees, so a
    lost executor costs the running tasks only, and row ids stay fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    (df.coalesce(parts) if parts else df).write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, parts: int | None = None) -> tuple[DataFrame, int]:
    """``stage`` and the number of rows, counted on the way."""
    seen = Observation()
    out = stage(df.observe(seen, F.count("*").alias("n")), name, parts)
    return out, seen.get["n"]


def parts_for(rows: int, per_part: int) -> int:
    """Tasks for so many rows: in proportion, ``LEAST_PARTS`` at least."""
    return max(LEAST_PARTS, -(-rows // per_part))


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers (once per Spark context), for
    sessions whose executors don't have it installed."""
    sc = spark.sparkContext
    name = "tablesync.zip"
    if name in sc._python_includes:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="tablesync-zip-"), name)
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path(root.name) / f.relative_to(root)))
    sc.addPyFile(target)


def arrow_map(df: DataFrame, fn: Callable, schema: str, rows: int = ARROW_ROWS) -> DataFrame:
    """``mapInArrow`` with this package available to the workers, in batches
    of few rows and bytes: texts are long, and a batch is held several times over."""
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(fn, schema)


_held: dict[object, object] = {}


def remembered(name: object, make: Callable):
    """What a Python worker keeps from task to task under ``name``: one thing at
    a time, so a worker that serves several operators holds one's memory."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def whole_text(text_col: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_key(text_col: str) -> Column:
    """64-bit fingerprint that, with the id, names a row across scans; a null
    text differs from an empty one."""
    return F.xxhash64(F.col(text_col), F.col(text_col).isNull())


def small(df: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``bound`` rows (stops counting beyond)."""
    return df.limit(bound + 1).count() <= bound


def broadcast_if_small(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only when its row count is within ``bound``."""
    return F.broadcast(df) if small(df, bound) else df


def rows_without(docs: DataFrame, drop: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose (id, text) is not in ``drop`` (id_col, text_key).

    The text crosses no shuffle while the dropped keys are few enough to
    broadcast; beyond that the anti-join shuffles."""
    right = broadcast_if_small(drop.select(F.col(id_col).alias("_drop_id"),
                                           F.col("text_key").alias("_drop_key")))
    same = (text_key(text_col) == F.col("_drop_key")) & F.col(id_col).eqNullSafe(F.col("_drop_id"))
    return docs.join(right, same, "left_anti")


def balanced(batches: Iterator[pa.RecordBatch], column: str,
             max_bytes: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slice Arrow batches so that each holds about ``max_bytes`` of text (one
    row at least); yields the slice and its texts, null as empty."""
    for batch in batches:
        sizes = batch.column(column)
        ends = pc.fill_null(pc.binary_length(sizes), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(ends):
            if i > start and total + n > max_bytes:
                part = batch.slice(start, i - start)
                yield part, [t or "" for t in part.column(column).to_pylist()]
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, [t or "" for t in part.column(column).to_pylist()]
