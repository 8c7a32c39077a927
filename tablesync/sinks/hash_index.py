"""Persistent hash index of a stored table (J-06, U-02, A-04).

The index is a side table of (tenant, hash prefix, hash), partitioned by tenant
and hash prefix, in the table's hidden ``_tablesync`` folder.  An append by hash
reads only the partitions of the tenants and prefixes that its increment has,
and only the hash column, instead of every hash of each touched tenant.

What the index covers is written down last: per tenant a fingerprint of the
tenant's data files (their names; data files never change).  A tenant whose
files are not those of its fingerprint, because a run stopped between its two
writes or because anything else wrote to the table, is indexed anew from its
rows before it is used.  So the index never has to be told of a write, and
equals a recount at any time that it is used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from . import writers as W

TENANT = W.TENANT
PREFIX = "hash_prefix"
PREFIX_DIGITS = 2           # 256 partitions a tenant
COMPACT_FILES = 8           # files of a (tenant, prefix) partition, on average, before they are rewritten


class HashIndex:
    """The index of the table at ``path``; ``digits`` hex digits of the hash
    make a prefix (recorded with the index, whose own number is kept)."""

    def __init__(self, spark: SparkSession, path: str, hash_col: str = "data_hash", digits: int = PREFIX_DIGITS):
        self.spark, self.path, self.hash_col = spark, path.rstrip("/"), hash_col
        self.folder = f"{self.path}/{W.NOTES}/hash_index"
        self.state = W.get_note(spark, self.path, "hash_index") or {"digits": digits, "tenants": []}
        self.digits = self.state["digits"]

    # ------------------------------------------------------------ state
    def _fingerprint(self, tenant: str | None) -> list:
        """Number and digest of the names of a tenant's data files."""
        fs, _ = W._fs(self.spark, self.path)
        root = W._partition_path(self.spark, self.path, TENANT, tenant)
        names = []
        if fs.exists(root):
            files = fs.listFiles(root, True)
            while files.hasNext():
                name = files.next().getPath().toString()
                if not name.rpartition("/")[2].startswith(("_", ".")):
                    names.append(name.split(f"{TENANT}=", 1)[1])
        return [len(names), hashlib.md5("\n".join(sorted(names)).encode()).hexdigest()]

    def _known(self) -> dict:
        return {t: f for t, f, _ in self.state["tenants"]}

    def _commit(self, tenants: Iterable[str | None], written: int) -> None:
        """Write down what the index covers: this comes after its files."""
        kept = {t: (f, n) for t, f, n in self.state["tenants"]}
        for t in tenants:
            kept[t] = (self._fingerprint(t), written if t not in kept or not written else kept[t][1] + written)
        self.state["tenants"] = [[t, f, n] for t, (f, n) in sorted(kept.items(), key=lambda x: (x[0] is None, x[0]))]
        W.put_note(self.spark, self.path, "hash_index", self.state)

    # ------------------------------------------------------------ entries
    def _entries_of(self, rows: DataFrame) -> DataFrame:
        return (rows.where(F.col(self.hash_col).isNotNull())
                .select(TENANT, F.substring(self.hash_col, 1, self.digits).alias(PREFIX), self.hash_col).distinct())

    def _write(self, entries: DataFrame) -> None:
        (W.layout(entries, (TENANT, PREFIX), self.hash_col).write.mode("append")
         .partitionBy(TENANT, PREFIX).parquet(self.folder))

    def _read(self) -> DataFrame:
        return (self.spark.read.schema(f"{self.hash_col} string, {TENANT} string, {PREFIX} string")
                .parquet(self.folder))

    def stale(self, tenants: Iterable[str | None]) -> list:
        """Tenants whose files are not those that were indexed."""
        known = self._known()
        return [t for t in tenants if known.get(t) != self._fingerprint(t)]

    def refresh(self, tenants: Iterable[str | None]) -> list:
        """Index stale tenants anew, from their rows; returns them."""
        stale = self.stale(tenants)
        if stale:
            if path_exists(self.spark, self.folder):
                W.drop_tenant_partitions(self.spark, self.folder, stale)
            target = W.prune_to_tenants(W.read_table(self.spark, self.path), stale)
            self._write(self._entries_of(target))
            self.state["tenants"] = [r for r in self.state["tenants"] if r[0] not in stale]
            self._commit(stale, 1)
        return stale

    def known(self, increment: DataFrame) -> DataFrame:
        """Entries (tenant, hash) in the partitions that ``increment`` touches:
        its tenants and its hash prefixes (at most 16 ** digits) are static
        partition filters of the scan."""
        if not path_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], f"{TENANT} string, {self.hash_col} string")
        touched = increment.select(TENANT, F.substring(self.hash_col, 1, self.digits).alias(PREFIX)).distinct()
        entries = W.prune_to_tenants(self._read(), W.touched_tenants(touched))
        return (W.prune_to_tenants(entries, W.touched_tenants(touched, PREFIX), PREFIX)
                .select(TENANT, self.hash_col))

    def add(self, rows: DataFrame) -> None:
        """Enter the hashes of rows that have been appended to the table."""
        tenants = W.touched_tenants(rows)
        self._write(self._entries_of(rows))
        self._commit(tenants, 1)
        self._compact([t for t, _, n in self.state["tenants"] if t in set(tenants) and n > COMPACT_FILES])

    def _compact(self, tenants: list) -> None:
        """Rewrite the entries of tenants that many appends have scattered over
        small files: they are read from the index itself, and a stop half-way
        leaves a stale tenant."""
        if not tenants:
            return
        self.state["tenants"] = [r for r in self.state["tenants"] if r[0] not in tenants]
        W.put_note(self.spark, self.path, "hash_index", self.state)
        with W.staging() as put:
            entries = put(W.prune_to_tenants(self._read(), tenants).distinct(), "index")
            W.drop_tenant_partitions(self.spark, self.folder, tenants)
            self._write(entries)
        self._commit(tenants, 1)


def append_stored(source: DataFrame, path: str, hash_col: str = "data_hash", index: HashIndex | None = None) -> DataFrame:
    """J-06 on a stored table: append the rows of ``source`` (with its hash)
    that their tenant does not have yet, and return them flagged as
    ``metrics.flag_present`` does.  Reads the touched index partitions only."""
    from ..operators.metrics import flag_present
    index = index or HashIndex(source.sparkSession, path, hash_col)
    staged = W.stage(source, "index-src")
    try:
        index.refresh(W.touched_tenants(staged))
        flagged = W.stage(flag_present(index.known(staged), staged, hash_col), "index-flagged")
    finally:
        W.release(staged)
    new = flagged.where(~F.col("_dup")).drop("_dup")
    W.write_append(new, path, (TENANT,))
    index.add(new)
    return flagged
