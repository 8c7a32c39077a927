"""Merges without row-level operations: anti-join + union recipes.

``merged = source ∪ (target ▷ source)`` where ▷ is a left-anti join on the
merge key.  The anti-join shuffles both sides on the (high-cardinality) key,
so a tenant holding a third of all rows does not make a hot task; when the
source is small AQE turns it into a broadcast from its measured size.
NULL keys never match (``=`` semantics), so such source rows are inserted
and such target rows kept, as in SQL MERGE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


TENANT = "tenant_id"


def _keys(keys: Sequence[str], tenant_col: str | None) -> list[str]:
    ks = list(keys)
    if tenant_col and tenant_col not in ks:
        ks.append(tenant_col)
    return ks


def any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(f"`{k}`").isNull()
    return out


def _hashable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    return not isinstance(dt, T.StructType) or all(_hashable(f.dataType) for f in dt.fields)


def _spread(df: DataFrame, nulls: Column) -> Column:
    """0, or a hash of the row where its key is NULL: a join key that keeps
    rows which match nothing from meeting in one partition."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    return F.when(nulls, F.xxhash64(*cols)).otherwise(F.lit(0).cast("bigint"))


def _anti_on(left: DataFrame, right_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose key has no match, in one scan of ``left``.  Rows with a
    NULL key can never match; all of them would hash to one shuffle partition
    (one hot task when a third of the rows lack a key), so they carry a spread."""
    # USING-style join on names: safe when both sides derive from one table
    right = right_keys.where(~any_null(keys)).withColumn("_spread", F.lit(0).cast("bigint"))
    return (left.withColumn("_spread", _spread(left, any_null(keys)))
            .join(right, [*keys, "_spread"], "left_anti").select(*[F.col(f"`{c}`") for c in left.columns]))


# ---------------------------------------------------------------- W-05
def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   tiebreak: Column | None = None) -> DataFrame:
    """W-05: one row per key: the newest ``order_col``; ties are broken by
    the row itself (columns compared in name order, NULL lowest), so equal
    rows are interchangeable and the choice is deterministic.

    ``row_number() ... = 1`` is planned with a partial ``WindowGroupLimit``
    before the shuffle: every map task keeps only its best row per key, so a
    hot key ships one row per input partition, never all its rows to one
    task.  No hashing or string formatting per row."""
    cols = df.columns
    orderable = [f.name for f in df.schema.fields if _hashable(f.dataType)]
    order = [F.col(f"`{order_col}`").desc_nulls_last()]
    if tiebreak is not None:
        order.append(tiebreak.desc_nulls_last())
    order += [F.col(f"`{c}`").desc_nulls_last() for c in sorted(orderable)]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).select(*[F.col(f"`{c}`") for c in cols]))


def one_per_key(source: DataFrame, keys: Sequence[str], latest_by: str | None = None,
                strict: bool = False) -> DataFrame:
    """The source of a merge with one row per key: the newest by ``latest_by``
    (without it, by the row itself).  ``strict`` raises on a repeated key
    instead.  Rows with a NULL key match nothing and all stay."""
    nulls = any_null(keys)
    keyed = source.where(~nulls)
    if strict:
        if not duplicate_keys(keyed, keys).isEmpty():
            raise ValueError(f"the source of the merge repeats a key ({', '.join(keys)})")
        return source
    return latest_per_key(keyed, keys, latest_by or keys[0]).unionByName(source.where(nulls))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (for strict merges)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


# ---------------------------------------------------------------- J-01 / J-02
def merge_on_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 tenant_col: str | None = TENANT, latest_by: str | None = None,
                 strict: bool = False) -> DataFrame:
    """J-01: upsert on key + tenant: matched target rows are replaced by the
    source row (every non-key column updated), unmatched source rows inserted.

    The source is first reduced to one row per key (W-05, newest by
    ``latest_by``); ``strict`` raises on a repeated key instead."""
    ks = _keys(keys, tenant_col)
    src = one_per_key(source, ks, latest_by, strict)
    src = src.select(*target.columns) if set(target.columns) <= set(src.columns) else src
    kept = _anti_on(target, src.select(*ks), ks)
    return src.unionByName(kept, allowMissingColumns=True)


def merge_on_key_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      latest_by: str | None = None) -> DataFrame:
    """J-02: upsert on the key alone (single-tenant tables): a source row
    replaces the target row with the same key whatever its tenant."""
    return merge_on_key(target, source, keys, tenant_col=None, latest_by=latest_by)


# ---------------------------------------------------------------- J-03
def merge_on_hash(target: DataFrame, source: DataFrame, hash_col: str = "data_hash",
                  tenant_col: str = TENANT) -> DataFrame:
    """J-03: upsert on (data_hash, tenant) for tables without a key."""
    return merge_on_key(target, source, [hash_col], tenant_col=tenant_col)


# ---------------------------------------------------------------- J-04
def merge_on_timestamp(target: DataFrame, source: DataFrame, ts_col: str,
                       tenant_col: str = TENANT) -> DataFrame:
    """J-04: upsert on (timestamp, tenant).  Distinct source rows sharing a
    timestamp would collide, so the source is first reduced to one row per
    key (W-05 tie-break)."""
    return merge_on_key(target, source, [ts_col], tenant_col=tenant_col, latest_by=ts_col)


# ---------------------------------------------------------------- J-05
def merge_shared_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                         tenant_col: str | None = TENANT,
                         latest_by: str | None = None) -> DataFrame:
    """J-05: upsert over the columns both sides share.  Result has the
    target's schema: shared columns take the source value on a match,
    target-only columns keep their value (NULL for inserted rows), source-only
    columns are dropped.  NULL keys never match and stay separate rows."""
    ks = _keys(keys, tenant_col)
    nulls = any_null(ks)
    # one source row per key: a full outer join must not pair duplicates
    src = latest_per_key(source.where(~nulls), ks, latest_by or ks[0])
    shared = [c for c in target.columns if c in set(src.columns)]
    types = {f.name: f.dataType for f in target.schema.fields}
    s = src.select(*shared).withColumns({"_src": F.lit(True), "_spread": F.lit(0).cast("bigint")}).alias("s")
    # one scan of the target: its rows with a NULL key match nothing and stay,
    # spread over the join's partitions
    t = target.withColumn("_spread", _spread(target, nulls)).alias("t")
    cond = [F.col(f"s.`{k}`") == F.col(f"t.`{k}`") for k in (*ks, "_spread")]
    j = t.join(s, cond, "full_outer")
    present = F.col("s._src").isNotNull()
    out = []
    for c in target.columns:
        if c in shared:
            col = F.when(present, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`"))
        else:
            col = F.col(f"t.`{c}`")
        out.append(col.cast(types[c]).alias(c))
    # NULL keys never match: such source rows are inserted
    s_null = source.where(nulls).select(*[
        (F.col(f"`{c}`") if c in shared else F.lit(None)).cast(types[c]).alias(c)
        for c in target.columns])
    return j.select(*out).unionByName(s_null)


# ---------------------------------------------------------------- J-06 / J-07 / A-04
def existing_hashes(target: DataFrame, tenant: str | None = None, hash_col: str = "data_hash",
                    tenant_col: str = TENANT) -> DataFrame:
    """A-04: distinct (tenant, hash) pairs present in the target, optionally
    for one tenant (partition-pruned).  Stays distributed; never collected."""
    t = target if tenant is None else target.where(F.col(tenant_col) == F.lit(tenant))
    return t.where(F.col(hash_col).isNotNull()).select(tenant_col, hash_col).distinct()


def _known(target: DataFrame, hash_col: str, tenant_col: str) -> tuple[DataFrame, Column]:
    """(tenant, hash) of the target's rows and the join condition; a NULL
    tenant is a tenant like any other."""
    have = target.where(F.col(hash_col).isNotNull()).select(
        F.col(tenant_col).alias("_known_tenant"), F.col(hash_col).alias("_known_hash"))
    return have, ((F.col(hash_col) == F.col("_known_hash"))
                  & F.col(tenant_col).eqNullSafe(F.col("_known_tenant")))


def append_new_by_hash(target: DataFrame, source: DataFrame, hash_col: str = "data_hash",
                       tenant_col: str = TENANT) -> DataFrame:
    """J-06: source rows whose hash is not yet in the target for their
    tenant.  Duplicates inside the source are all kept (as the reference)."""
    return source.join(*_known(target, hash_col, tenant_col), "left_anti")


def already_present_rows(target: DataFrame, source: DataFrame, hash_col: str = "data_hash",
                         tenant_col: str = TENANT) -> DataFrame:
    """J-07: source rows whose (tenant, hash) already exists in the target."""
    return source.join(*_known(target, hash_col, tenant_col), "left_semi")


# ---------------------------------------------------------------- J-08
def append_blind(target: DataFrame, source: DataFrame) -> DataFrame:
    """J-08: plain append (no key, no hash); a lookback re-read repeats rows."""
    return target.unionByName(source, allowMissingColumns=True)
