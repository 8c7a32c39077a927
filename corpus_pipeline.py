"""Corpus pipeline: a table of documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet to the shared checkpoint folder and read again as the next one's
``docs``.  All but the last return the columns of ``docs``.  Null ids, null
texts, repeated rows and clashing column names are handled as the operators
say; an empty table runs through to an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import rows_without, stage, table
from tablesync.llm.decontaminate import contamination
from tablesync.llm.exact_dup import drop_copies
from tablesync.llm.near_dup import near_duplicates
from tablesync.llm.packing import pack_documents
from tablesync.llm.quality import keep_good
from tablesync.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    configure(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id."""
    configure(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest
    id.  Documents without an id are no component's and stay."""
    configure(spark)
    rows = stage(near_duplicates(docs), "near-rows")
    drop = rows.filter("not kept and doc_id is not null").select(F.col("doc_id"), "text_key")
    return rows_without(docs, drop, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark phrase."""
    configure(spark)
    rows = stage(contamination(docs, table(spark, sf_dir, "benchmark")), "decon-rows")
    return rows_without(docs, rows.filter("contaminated"), "doc_id", "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in sequences."""
    configure(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

# Trained scores and packing have no SQL form; tests hold run() against a
# brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
