"""Row transforms: system columns, type normalisation, quarantine, alignment.

Every operator is one ``select`` of built-in expressions, so a whole chain
compiles into a single whole-stage-codegen projection after the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import iso_text, to_target
from ..functions.timeutil import ts_lit
from ..functions.types import target_type_py

SYSTEM_COLUMNS = ("tenant_id", "sync_timestamp", "sync_mode")
NUMERIC_TARGETS = ("INT64", "FLOAT64", "NUMERIC")


# ---------------------------------------------------------------- PR-01
def add_system_columns(df: DataFrame, tenant: str | Column | None, run_time: datetime | str,
                       sync_mode: str, tenant_col: str = "tenant_id") -> DataFrame:
    """PR-01: tenant, one run time for every row (a literal, never
    ``current_timestamp()``), and the sync mode.

    ``tenant`` may be a literal, a Column, or None to keep an existing
    ``tenant_id`` column (one scan over many tenants)."""
    cols: dict[str, Column] = {
        "sync_timestamp": ts_lit(run_time),
        "sync_mode": F.lit(sync_mode),
    }
    if tenant is not None:
        cols[tenant_col] = tenant if isinstance(tenant, Column) else F.lit(tenant)
    return df.withColumns(cols)


# ---------------------------------------------------------------- PR-02..05
def _targets(field_types: Mapping[str, str]) -> dict[str, tuple[str, str]]:
    return {c: (target_type_py(t), t) for c, t in field_types.items()}


def _converted(df: DataFrame, field_types: Mapping[str, str],
               keep: Sequence[str]) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    tgt = _targets(field_types)
    out: dict[str, Column] = {}
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in keep:
            out[name] = c
        elif name in tgt:
            target, src = tgt[name]
            out[name] = to_target(c, target, types[name], src)
        else:  # PR-05: outside the known schema -> text, NULL stays NULL
            out[name] = c.cast("string")
    return out


def normalize_types(df: DataFrame, field_types: Mapping[str, str],
                    keep: Sequence[str] = SYSTEM_COLUMNS) -> DataFrame:
    """PR-02: convert every column to the target type of its source type.

    Text that does not parse becomes NULL here; use
    :func:`quarantine_bad_values` to keep it aside."""
    conv = _converted(df, field_types, keep)
    return df.select(*[conv[n].alias(n) for n in df.columns])


def _bad_condition(orig: Column, new: Column, target: str) -> Column:
    present = orig.isNotNull()
    if target in NUMERIC_TARGETS:
        present = present & (orig.cast("string") != F.lit(""))
    return present & new.isNull()


def quarantine_bad_values(df: DataFrame, field_types: Mapping[str, str],
                          keep: Sequence[str] = SYSTEM_COLUMNS,
                          out_col: str = "bad_values") -> DataFrame:
    """PR-04: typed columns plus ``bad_values MAP<column, original text>``.

    A Spark column has one type, so a value that does not convert cannot stay
    in place as text (as the reference did); it moves to the side map and
    the typed value is NULL."""
    conv = _converted(df, field_types, keep)
    tgt = _targets(field_types)
    entry_type = T.StructType([T.StructField("key", T.StringType(), False),
                               T.StructField("value", T.StringType(), True)])
    entries = []
    for name, (target, _src) in tgt.items():
        if name not in df.columns or name in keep:
            continue
        orig = F.col(f"`{name}`")
        entry = F.struct(F.lit(name).alias("key"), orig.cast("string").alias("value"))
        # one-element or empty array per column, concatenated: no lambda
        # function, so the map is built inside whole-stage codegen
        entries.append(F.when(_bad_condition(orig, conv[name], target), F.array(entry))
                       .otherwise(F.array().cast(T.ArrayType(entry_type))))
    bad = (F.map_from_entries(F.concat(*entries))
           if entries else F.create_map().cast("map<string,string>"))
    return df.select(*[conv[n].alias(n) for n in df.columns], bad.alias(out_col))


def bad_value_rows(quarantined: DataFrame, key_cols: Sequence[str],
                   map_col: str = "bad_values") -> DataFrame:
    """Long form of the quarantine: one row per (key, column, raw text).

    Exploding the map's entry array (same rows, same order as exploding the
    map) keeps the map from being rebuilt in the filter Spark infers for
    generators."""
    e = F.explode(F.map_entries(map_col)).alias("_e")
    return (quarantined.select(*key_cols, e)
            .select(*key_cols, F.col("_e.key").alias("column_name"),
                    F.col("_e.value").alias("raw_value")))


# ---------------------------------------------------------------- A-06
def conversion_stats(df: DataFrame, field_types: Mapping[str, str],
                     keep: Sequence[str] = SYSTEM_COLUMNS) -> DataFrame:
    """A-06: per column, how many present values changed their text when
    normalised (values quarantined as bad are not conversions); only > 0.

    One aggregation pass over all columns, then ``stack`` to long form."""
    conv = _converted(df, field_types, keep)
    tgt = _targets(field_types)
    aggs, meta = [], []
    for name, (target, src) in tgt.items():
        if name not in df.columns or name in keep:
            continue
        orig, new = F.col(f"`{name}`"), conv[name]
        changed = (orig.isNotNull() & ~_bad_condition(orig, new, target)
                   & ~orig.cast("string").eqNullSafe(new.cast("string")))
        aggs.append(F.count_if(changed).alias(f"c{len(aggs)}"))
        meta.append((name, src, target))
    if not aggs:
        return df.sparkSession.createDataFrame(
            [], "column_name string, source_type string, target_type string, conversions bigint")
    wide = df.agg(*aggs)
    parts = []
    for i, (name, src, target) in enumerate(meta):
        parts.append(F.struct(F.lit(name).alias("column_name"), F.lit(src.lower()).alias("source_type"),
                              F.lit(target).alias("target_type"),
                              F.col(f"c{i}").cast("bigint").alias("conversions")))
    return (wide.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
            .where(F.col("conversions") > 0))


# ---------------------------------------------------------------- PR-06
def align_to_target(df: DataFrame, target: DataFrame | T.StructType) -> DataFrame:
    """PR-06: keep the target's columns in the target's order; columns the
    source lacks become typed NULLs; source-only columns are dropped.  With
    no column in common the source is returned unchanged (as the reference)."""
    schema = target.schema if isinstance(target, DataFrame) else target
    have = set(df.columns)
    if not any(f.name in have for f in schema.fields):
        return df
    return df.select(*[
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


# ---------------------------------------------------------------- PR-07/08/09
def iso_timestamps(df: DataFrame) -> DataFrame:
    """PR-07: timestamps -> ISO-8601 text, dates -> ``yyyy-MM-dd``,
    decimals -> double: the text form the reference loaded.  Only for text
    sinks; typed sinks keep native types."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = iso_text(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- PR-10
