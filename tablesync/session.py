"""Session settings and shared scratch locations.

Everything the library writes outside a caller-given path (staged merge
results, test round trips) goes under the cluster's shared checkpoint
directory, read from ``spark.checkpoint.dir``.  Only when that setting is
unset (local tests) do we choose one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  Dynamic partition overwrite is what makes
# tenant-scoped replacement leave other tenants alone; UTC keeps run times and
# naive source timestamps comparable.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tenant partition values stay text ("007" is not the number 7)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tablesync") -> SparkSession:
    """Session for tests and the bench (local mode, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # reliable checkpoints (paging) are removed once no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    If none is named, a local session (tests) gets one under the system temp
    folder; on a cluster that would be a folder of one machine, so it raises.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if cur:
        return cur.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="tablesync-ckpt-")
    sc.setCheckpointDir(path)
    return (sc.getCheckpointDir() or path).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/tablesync-scratch/{name}-{uuid.uuid4().hex[:12]}"


def to_local(path: str) -> str:
    """Strip a ``file:`` scheme so the path can be used with os.path."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


__all__ = [
    "REQUIRED_CONF", "configure", "local_session", "checkpoint_root",
    "scratch_path", "to_local", "path_exists",
]
