"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line stripped of blanks with A-Z lower-cased; a 128-bit
hash stands for it.  Documents come in batches.  A batch's distinct hashes are
written as a sorted run; merge-anti-joining it with the runs of earlier batches
leaves the hashes that are new, which become a run of level 0.  ``FANOUT`` runs
of a level are merged into one of the next, so a hash is rewritten once a level
and a batch meets a logarithmic number of runs.  All runs are Parquet tables
bucketed and sorted by the hash, with the same number of buckets: their joins
and merges read bucket by bucket, without a shuffle.

Of a key, the lines of the first document that holds it stay (the smallest id
of the first batch); the lines of all other documents go.

``dedup_lines`` runs a whole table as batches of rising ids: one scan hashes
the lines (written once, by batch), one scan rebuilds the texts.  Keys are
combined before they are shuffled, so a common line is one row a task; where
lines meet the repeated keys, both sides have an exchange of their own, which
AQE splits for a hot key.  ``LineRuns.open`` continues a stored state.

Edge cases: a null text is an empty text, one empty line; a null id counts as
one document after all ids; rows with one id are one document (a repeated row
keeps what its twin keeps); keys under ``MIN_CHARS`` code points never repeat;
a document may lose all its lines; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import lower_ascii, stage, text_key, whole_text
from tablesync.session import path_exists, scratch_path

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
BLANKS = " \t\n\x0b\f\r"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(BLANKS))
    # lower() folds more than A-Z, but not in a line of one-byte characters
    return F.when(F.octet_length(stripped) == F.length(stripped), F.lower(stripped)).otherwise(lower_ascii(stripped))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: Column | None = None,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per line whose key may repeat: batch, id, text_key, pos, h1, h2."""
    lines = docs.select((F.lit(0) if batch is None else batch).alias("batch"), F.col(id_col).alias("id"),
                        text_key(text_col).alias("text_key"),
                        F.posexplode(F.split(whole_text(text_col), "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("line_key", line_key(F.col("line"))).filter(F.length("line_key") >= min_chars)
    return keyed.select("batch", "id", "text_key", "pos", F.xxhash64("line_key").alias("h1"),
                        F.xxhash64(F.lit(1), "line_key").alias("h2"))


class LineRuns:
    """The levelled runs: what earlier batches have shown.

    A run is a folder under ``folder``; the newest manifest names the runs that
    count, and is written after them, so a batch that failed half-way leaves
    the state as it was."""

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None,
                 fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.folder = folder or scratch_path(spark, "llm-line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.version = 0
        self.levels: list[list[str]] = []       # names of runs by level
        self.tables: set[str] = set()           # of these, in the session's catalog

    @classmethod
    def open(cls, spark: SparkSession, folder: str, fanout: int = FANOUT) -> LineRuns:
        """The state that ``folder`` holds (none yet: an empty one)."""
        runs = cls(spark, folder, fanout=fanout)
        while path_exists(spark, f"{folder}/manifest-{runs.version + 1}/_SUCCESS"):
            runs.version += 1
        if runs.version:
            listed = spark.read.schema("level int, run string, buckets int").json(
                f"{folder}/manifest-{runs.version}").collect()
            runs.buckets = listed[0]["buckets"]
            runs.levels = [[] for _ in range(max(r["level"] for r in listed) + 1)]
            for r in sorted(listed, key=lambda r: (r["level"], r["run"])):
                runs.levels[r["level"]].append(r["run"])
        return runs

    def _write(self, df: DataFrame) -> str:
        """A sorted run of ``df``."""
        name = f"run_{uuid.uuid4().hex}"
        self.tables.add(f"tablesync_{name}")
        (df.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
         .option("path", f"{self.folder}/{name}").saveAsTable(f"tablesync_{name}"))
        return name

    def _read(self, name: str) -> DataFrame:
        table = f"tablesync_{name}"
        if table not in self.tables:
            self.tables.add(table)
            path = f"{self.folder}/{name}"
            columns = self.spark.read.parquet(path).schema
            ddl = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in columns)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet CLUSTERED BY (h1, h2) "
                           f"SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def _merge(self, names: list[str]) -> str:
        """One run of several: their hashes are disjoint, so a full outer merge
        join of two sorted runs is their union, bucket by bucket."""
        merged, *rest = names
        for name in rest:
            a, b = self._read(merged).alias("a"), self._read(name).alias("b")
            same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
            merged = self._write(a.join(b, same, "full").select(
                *[F.coalesce(f"a.{h}", f"b.{h}").alias(h) for h in HASH]))
        return merged

    def _commit(self) -> None:
        self.version += 1
        rows = [(level, run, self.buckets) for level, own in enumerate(self.levels) for run in own]
        (self.spark.createDataFrame(rows, "level int, run string, buckets int").coalesce(1)
         .write.mode("overwrite").json(f"{self.folder}/manifest-{self.version}"))

    def add(self, lines: DataFrame) -> DataFrame:
        """Take a batch's lines (id, h1, h2) in.  Returns the keys that lose
        lines in this batch: h1, h2, ``seen`` (an earlier batch holds the key: all
        its lines go) and ``keep`` (else the id that keeps them)."""
        own = lines.groupBy(*HASH).agg(
            F.min("id").alias("keep"),
            ((F.min("id") < F.max("id")) | (F.max(F.col("id").isNull()) & F.min("id").isNotNull())).alias("many"))
        batch = self._write(own)
        fresh_name = batch
        earlier = self.runs()
        if earlier:
            fresh = reduce(lambda left, run: left.join(self._read(run), HASH, "left_anti"),
                           earlier, self._read(batch))
            fresh_name = self._write(fresh)
        fresh = self._read(fresh_name)
        hits = fresh.filter("many").select(*HASH, "keep", F.lit(False).alias("seen"))
        if earlier:
            old = self._read(batch).join(fresh, HASH, "left_anti")
            hits = hits.unionByName(old.select(*HASH, F.lit(None).cast(fresh.schema["keep"].dataType).alias("keep"),
                                               F.lit(True).alias("seen")))
        level = 0
        run = fresh_name
        while True:                               # compaction
            if len(self.levels) <= level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                break
            run = self._merge(self.levels[level])
            self.levels[level] = []
            level += 1
        self._commit()
        return hits

    def forget_tables(self) -> None:
        """Take the runs' names out of the session's catalog; files stay."""
        while self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")


def without_lines(docs: DataFrame, lines: DataFrame, hits: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, text_key, ``n_lines``, ``n_dropped`` and the
    kept ``text``.  ``hits`` are the keys that ``LineRuns.add`` returned, with
    ``batch`` (staged: the join then has exchanges that AQE can split)."""
    h = hits.alias("h")
    same = (lines.batch == F.col("h.batch")) & (lines.h1 == F.col("h.h1")) & (lines.h2 == F.col("h.h2"))
    gone = (lines.join(h, same).filter(F.col("h.seen") | ~lines.id.eqNullSafe(F.col("h.keep")))
            .select(lines.id.alias("gone_id"), lines.text_key.alias("gone_key"), lines.pos)
            .groupBy("gone_id", "gone_key").agg(F.collect_set("pos").alias("gone")))
    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"),
                       F.split(whole_text(text_col), "\n", -1).alias("all_lines"))
    met = rows.join(gone, rows.id.eqNullSafe(gone.gone_id) & (rows.text_key == gone.gone_key), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("all_lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("all_lines")).otherwise(
        F.transform(left, lambda i: F.get(F.col("all_lines"), i)))
    return met.select(F.col("id").alias(id_col), "text_key", F.size("all_lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.array_join(kept, "\n").alias("text"))


def _bounds(docs: DataFrame, id_col: str, batches: int) -> list:
    """Ids that part ``docs`` into batches of about equal size; none where ids
    are no numbers."""
    if batches < 2 or not isinstance(docs.schema[id_col].dataType, T.NumericType):
        return []
    shares = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx(id_col, shares)).first()[0]
    return sorted(set(found or []))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES,
                min_chars: int = MIN_CHARS, runs: LineRuns | None = None) -> DataFrame:
    """``without_lines`` for a whole table, taken in batches of rising ids.
    With ``runs`` lines that earlier calls have shown go as well, and this
    table's lines are remembered there."""
    spark = docs.sparkSession
    bounds = _bounds(docs, id_col, batches)
    batch = sum((F.col(id_col) > b).cast("int") for b in bounds) if bounds else F.lit(0)
    batch = F.coalesce(batch, F.lit(len(bounds)))
    path = scratch_path(spark, "llm-lines")
    hashed = line_hashes(docs, id_col, text_col, batch, min_chars)
    hashed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashed.schema).parquet(path)
    runs = runs or LineRuns(spark)
    found = [runs.add(lines.filter(F.col("batch") == b)).withColumn("batch", F.lit(b))
             for b in range(len(bounds) + 1)]
    hits = stage(reduce(DataFrame.unionByName, found), "line-hits")
    runs.forget_tables()
    return without_lines(docs, lines, hits, id_col, text_col)
