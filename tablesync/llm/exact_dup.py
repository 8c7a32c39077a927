"""Exact deduplication by progressive refinement.

Texts are compared after every run of blanks (``[\\x20\\x09-\\x0D]+``) became
one space.  Groups are refined by length, then by a hash of the first
characters, then by SHA-256 of the whole text.  Two scans, no text in a
shuffle:

1. length and prefix hash are counted together (a row per distinct pair after
   map-side combine, so a hot group of copies is one row a task);
2. the pairs that occur more than once become a fixed number of hash buckets,
   a broadcast bounded by that number; the second scan digests the whole text
   of the rows in those buckets only.  Two pairs may share a bucket: that costs
   a digest, never a result.

Only digests are grouped and joined; a hot digest is combined before the
shuffle and the join back splits under AQE.

Edge cases: null text is an empty text; a null id sorts after every id; fully
repeated rows form a group of which exactly one row is kept; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import broadcast_if_small, rows_without, stage, text_key, whole_text

BLANKS = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 256
BUCKETS = 1 << 20


def normalised(text_col: str) -> Column:
    return F.regexp_replace(whole_text(text_col), BLANKS, " ")


def _bucket(length: str, prefix: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(buckets))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix_chars: int = PREFIX_CHARS, buckets: int = BUCKETS,
                 digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` and ``text_key`` (the row's fingerprint).

    ``digest_all`` also digests the rows that no group needs; without it their
    ``text_sha256`` is null."""
    norm = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"),
                       text_key(text_col).alias("text_key"))
    sized = norm.select("*", F.length("norm").alias("n"),
                        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("p"))

    shared = (sized.groupBy("n", "p").agg(F.count("*").alias("c")).filter("c > 1")
              .select(_bucket("n", "p", buckets).alias("bucket")).distinct())
    shared = F.broadcast(shared.withColumn("suspect", F.lit(True)))

    digest = F.unhex(F.sha2("norm", 256))
    facts = (sized.withColumn("bucket", _bucket("n", "p", buckets))
             .join(shared, "bucket", "left")
             .select(F.monotonically_increasing_id().alias("row"), "id", "text_key",
                     F.coalesce("suspect", F.lit(False)).alias("suspect"),
                     (digest if digest_all else F.when(F.col("suspect"), digest)).alias("digest")))
    facts = stage(facts, "exact-facts")

    suspects = facts.filter("suspect")
    first = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row")).alias("first")
    # staged: the join back then has its own exchanges, which AQE can split
    groups = stage(suspects.groupBy("digest").agg(first, F.count("*").alias("group_size")),
                   "exact-groups")
    many = suspects.join(groups, "digest").select(
        "id", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "digest", "text_key")
    alone = facts.filter("not suspect").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest", "text_key")
    return many.unionByName(alone).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"), "text_key")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops, columns as given."""
    rows = stage(exact_groups(docs, id_col, text_col), "exact-rows")
    # A fully repeated row shares its key with the row that is kept: such keys
    # leave through dropDuplicates (map-side combined), all others by anti-join.
    same = (rows.groupBy(id_col, "text_key")
            .agg(F.count("*").alias("c"), F.max("kept").alias("kept")))
    gone = rows_without(docs, same.filter("not kept"), id_col, text_col)
    twice = same.filter("kept and c > 1").select(id_col, "text_key")
    if twice.isEmpty():
        return gone
    single = rows_without(gone, twice, id_col, text_col)
    left = broadcast_if_small(twice.select(F.col(id_col).alias("_keep_id"),
                                           F.col("text_key").alias("_keep_key")))
    repeated = gone.join(left, (text_key(text_col) == F.col("_keep_key"))
                         & F.col(id_col).eqNullSafe(F.col("_keep_id")), "left_semi")
    return single.unionByName(repeated.dropDuplicates([id_col, text_col]))
