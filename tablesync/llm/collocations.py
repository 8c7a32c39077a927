"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut into pieces and words; a word is hashed with its language, so a
graph node belongs to one language.

1. The texts are cut into words once and staged as numbers of words, each row with
   the words it numbers (see ``number_words``).  What follows reads these rows: it
   counts or hashes a row's distinct words and looks the numbers up.
2. Words are counted per language (combined in each task, then shuffled).
   Hashes that two words share are looked for; if a frequent word has one, the
   hash seed changes.
3. No phrase of ``min_count`` runs over a word, a word pair, a triple or four words
   that are rarer.  Frequent words get numbers, by which a scan counts the pairs of
   them.  For three and four words a scan adds those that the filters before let pass
   to counters, found by their hash, two for each ``min_count`` words of the corpus.
   A bitmap marks what is frequent.  It may let a rare one pass, never call a
   frequent one rare, so no wanted count changes.
4. The longest gram (up to ``MAX_WORDS``) that starts at each place and runs over
   nothing rare is an edge between the overlapping nodes of one word less, or,
   where it is shorter, an end: of the piece, or of what can be frequent in it.
   Those of three words or more are counted in their task, then summed by Spark;
   the ends of a pair or word are its count, known by now, less what goes on from it.
5. Unary paths (a node that one edge enters, one leaves, where nothing starts or ends)
   are compacted: in each of ``ROUNDS`` rounds, nodes picked by a coin of their
   hash join their two paths into one, so a row stays short whatever the length
   of a repeated passage.
6. The count of a node is the flow that leaves it plus its piece ends; shorter
   grams follow level by level in the same way.
7. Candidates meet the counts of their parts in shuffled joins; scores are exact
   decimals; those inside a longer candidate of the same count go; the first
   ``top`` of each language are found in salted groups, then among what is left.

One scan of the texts and five of the numbers, from which nothing but sums leaves a
task; the driver gets the three bitmaps (2 ** ``BITS`` bits each at most, whatever the input), 8 bytes
for each frequent word and a number of rows.

Edge cases: a null or empty text has no piece; a null language is ``und``; null
and repeated ids matter to nothing, repeated rows count again; a very long piece
is one piece; ties rank by count and then by the phrase's bytes; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_map, balanced, stage

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
UNKNOWN = "und"
ROUNDS = 3
BITS = 27                 # a filter has 2 ** BITS bits at most: 16 MB
BLOCK_BITS = 15           # a row that hands on counters of a filter holds 2 ** BLOCK_BITS
COUNTING_TASKS = 64       # tasks that hand on counters (the default parallelism, where that is more)
FILTERS = (2, 3, 4)       # words of the grams that are filtered
HELD = 1 << 19            # counts that a task sums up before it hands them on
GROUP_ROWS = 100_000      # rows that one ranking group should hold
ROW_WORDS = 1 << 17       # words of a row of staged numbers
BATCH_ROWS = 8            # rows of staged numbers that a task gets at a time
# staged numbers: row groups of bounded bytes, though a row is long
ROW_GROUPS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}
NUMBERED = "lang string, words binary, ids binary"

# A-Z to a-z, a tab to a space, what ends a piece to a full stop
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
                        b"abcdefghijklmnopqrstuvwxyz .........."
                        )
_END = b"."


def tokens(texts: list[str]) -> list[bytes]:
    """Words of the texts, with a full stop at the end of each piece."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_FOLD)
    return raw.replace(_END, b" . ").split(b" ")


class _Numbers(dict):
    """Numbers words in the order in which they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


def number_words(texts: list[str], numbers: _Numbers) -> np.ndarray:
    """The texts' words by their numbers, a piece end after each text."""
    return np.fromiter(map(numbers.__getitem__, filter(None, tokens([*texts, ""]))), np.uint32)


def _id_type(words: int) -> type:
    return np.uint16 if words <= 1 << 16 else np.uint32


def word_hashes(words: list[bytes], lang: str, seed: int) -> np.ndarray:
    """Hashes of the words; 0 for the end of a piece."""
    import xxhash

    digest, prefix = xxhash.xxh3_64_intdigest, lang.encode() + b"\0"
    return np.fromiter((0 if w == _END else digest(prefix + w, seed) or 1 for w in words), np.uint64, len(words))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of neighbouring words; 0 where either is a piece end."""
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + (a >> np.uint64(29)))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(31)
    h[(a == 0) | (b == 0)] = 0
    return h


def counter_bits(words: int, min_count: int) -> int:
    """2 to this power are the counters of a filter: so many that ``min_count`` / 2 words
    at most fall on one on average, as far as ``BITS`` allows."""
    return min(BITS, max(BLOCK_BITS, (2 * words // min_count).bit_length()))


def place(hashes: np.ndarray, bits: int | None = None) -> np.ndarray:
    """The bit, of 2 ** ``bits`` of a filter, that belongs to a hash."""
    return (hashes >> np.uint64(64 - (bits or BITS))).astype(np.int64)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = place(hashes, len(bits).bit_length() + 2)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) & (hashes != 0)


def frequent_numbers(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The words' places, from 1, in the sorted hashes ``frequent``; 0 for a rare word or a piece end."""
    own = words.view(np.int64)
    at = np.searchsorted(frequent, own)
    found = (at < len(frequent)) & (own != 0)
    found[found] = frequent[at[found]] == own[found]
    return np.where(found, at + 1, 0)


def frequent_words(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """``words`` with those that are too rare turned into piece ends."""
    return np.where(frequent_numbers(words, frequent) > 0, words, np.uint64(0))


def pair_keys(numbers: np.ndarray) -> np.ndarray:
    """The numbers of each two neighbours that are frequent, in one."""
    a, b = numbers[:-1], numbers[1:]
    return ((a << 32) | b)[(a > 0) & (b > 0)]


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on; 0 where a piece ends among them."""
    h = words
    for k in range(1, size):
        h = pair_hash(h[:max(0, len(words) - k)], words[k:])
    return h


def reach(words: np.ndarray, filters: dict[int, np.ndarray], width: int) -> np.ndarray:
    """How many words, up to ``width``, run from each place on without the end
    of their piece and without a gram that a filter (bits by size) stops."""
    n = len(words)
    alive = words != 0
    out = alive.astype(np.int64)
    stops = {size: np.append(passes(bits, gram_hashes(words, size)), np.zeros(min(n, size - 1), bool))
             for size, bits in filters.items()}
    for k in range(2, width + 1):
        ahead = np.append(words[k - 1:], np.zeros(min(n, k - 1), np.uint64)) != 0
        alive = alive & ahead
        for size, ok in stops.items():
            if size <= k:
                alive &= np.append(ok[k - size:], np.zeros(min(n, k - size), bool))
        out += alive
    return out


def grams(words: np.ndarray, filters: dict[int, np.ndarray], width: int) -> np.ndarray:
    """A row per word: the gram of up to ``width`` words that starts there (see
    ``reach``), filled up with zeros."""
    n = len(words)
    length = reach(words, filters, width)
    padded = np.append(words, np.zeros(width, np.uint64))
    out = np.stack([np.where(length > k, padded[k:n + k], np.uint64(0)) for k in range(width)], axis=1)
    return out[words != 0]


def summed_grams(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``grams`` that differ, with their numbers (or sums of ``counts``).  Sorted by a
    hash; where two rows share one, a row may come twice, its numbers still add up."""
    key = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        key = key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k]
    order = np.argsort(key)
    rows = rows[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(first)
    if counts is None or not len(at):
        return rows[at], np.diff(np.append(at, len(rows)))
    return rows[at], np.add.reduceat(counts[order], at)


def _by_lang(part: pa.RecordBatch, texts: list[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for lang, text in zip(part.column("lang").to_pylist(), texts):
        out.setdefault(lang, []).append(text)
    return out


def _numbered(slim: DataFrame) -> DataFrame:
    """lang, words, ids: the texts of about ``ROW_WORDS`` words of a language as numbers,
    and the words that these stand for."""
    def rows(found: dict[str, tuple[_Numbers, list[np.ndarray]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()),
             pa.array([b" ".join(numbers) for numbers, _ in found.values()], pa.binary()),
             pa.array([np.concatenate(ids).astype(_id_type(len(numbers))).tobytes()
                       for numbers, ids in found.values()], pa.binary())], ["lang", "words", "ids"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        sizes: Counter = Counter()
        for part, texts in balanced(batches, "text"):
            for lang, own in _by_lang(part, texts).items():
                numbers, ids = found.setdefault(lang, (_Numbers(), []))
                ids.append(number_words(own, numbers))
                sizes[lang] += len(ids[-1])
                if sizes[lang] > ROW_WORDS:
                    yield rows({lang: found.pop(lang)})
                    del sizes[lang]
            if sum(sizes.values()) > 4 * ROW_WORDS:
                yield rows(found)
                found, sizes = {}, Counter()
        yield rows(found)

    return arrow_map(slim, work, NUMBERED)


def _read_numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Language, distinct words (the end of a piece first) and the words' numbers of each row."""
    for batch in batches:
        for lang, words, ids in zip(*(batch.column(c) for c in ("lang", "words", "ids"))):
            own = words.as_py().split(b" ")
            yield lang.as_py(), own, np.frombuffer(ids.as_py(), _id_type(len(own)))


def _vocabulary(numbered: DataFrame, seed: int) -> DataFrame:
    """lang, word, h, c: every word with its count."""
    def counted(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            hashes = word_hashes(list(counts), lang, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()),
                 pa.array(hashes.view(np.int64)), pa.array(list(counts.values()), pa.int64())],
                ["lang", "word", "h", "c"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for lang, words, ids in _read_numbered(batches):
            counts = np.bincount(ids, minlength=len(words)).tolist()
            found.setdefault(lang, Counter()).update(dict(zip(words[1:], counts[1:])))
            if sum(map(len, found.values())) > HELD:
                yield from counted(found)
                found = {}
        yield from counted(found)

    rows = arrow_map(numbered, work, "lang string, word string, h long, c long", BATCH_ROWS)
    return rows.groupBy("lang", "word", "h").agg(F.sum("c").alias("c"))


def _filter_bits(found: DataFrame, hash_col: str) -> np.ndarray:
    """A bitmap of the hashes in ``found``: at most 2 ** BITS bits come to the driver."""
    at = F.shiftrightunsigned(hash_col, 64 - BITS) + 1    # bit positions count from 1
    chunks = (found.select(F.bitmap_bucket_number(at).alias("chunk"), F.bitmap_bit_position(at).alias("bit"))
              .groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in chunks:
        start = (r["chunk"] - 1) * 4096
        out[start:start + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _read_shared(shared: dict) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Sorted hashes of the frequent words, and the filters' bits by size."""
    return (np.frombuffer(shared[1].value, np.int64),
            {size: np.frombuffer(bits.value, np.uint8) for size, bits in shared.items() if size > 1})


def _frequent_pairs(numbered: DataFrame, seed: int, shared: dict, min_count: int) -> DataFrame:
    """w1, w2, h, c: the pairs of frequent words that occur ``min_count`` times, their hash and count."""
    def summed(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, c = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(c.astype(np.int64))], ["pair", "c"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _ = _read_shared(shared)
        held: list[np.ndarray] = []
        for lang, words, ids in _read_numbered(batches):
            held.append(pair_keys(frequent_numbers(word_hashes(words, lang, seed), frequent)[ids]))
            if sum(map(len, held)) > 8 * HELD:
                yield summed(held)
                held = []
        yield summed(held)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _ = _read_shared(shared)
        for batch in batches:
            key = batch.column("pair").to_numpy()
            a, b = frequent[(key >> 32) - 1], frequent[(key & 0xFFFFFFFF) - 1]
            h = pair_hash(a.view(np.uint64), b.view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(h), batch.column("c")],
                                             ["w1", "w2", "h", "c"])

    rows = arrow_map(numbered, work, "pair long, c long", BATCH_ROWS)
    counts = rows.groupBy("pair").agg(F.sum("c").alias("c")).filter(F.col("c") >= min_count)
    return arrow_map(counts, named, "w1 long, w2 long, h long, c long")


def _frequent_places(numbered: DataFrame, seed: int, shared: dict, size: int, least: int, bits: int) -> np.ndarray:
    """A bitmap of the places of a filter (2 ** ``bits``) on which ``least`` grams of ``size``
    words fall, of those that the filters of fewer words let pass.  A task adds all it
    reads to one set of counters, which stop at ``least``, and hands on these."""
    kind = np.min_scalar_type(least)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, filters = _read_shared(shared)
        counters = np.zeros(1 << bits, kind)
        for lang, words, ids in _read_numbered(batches):
            words = frequent_words(word_hashes(words, lang, seed), frequent)[ids]
            hashes = gram_hashes(words, size)
            hashes = hashes[reach(words, filters, size)[:len(hashes)] >= size]
            at, c = np.unique(place(hashes, bits), return_counts=True)
            counters[at] = np.minimum(counters[at] + c, least)
        blocks = counters.reshape(-1, 1 << BLOCK_BITS)
        for block in np.flatnonzero(blocks.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([blocks[block].tobytes()])],
                                             ["block", "counters"])

    def summed(rows: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK_BITS, np.int64)
        for counters in rows.column("counters"):
            total += np.frombuffer(counters.as_py(), kind)
        marks = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.table({"block": rows.column("block").slice(0, 1), "marks": pa.array([marks])})

    tasks = max(COUNTING_TASKS, numbered.sparkSession.sparkContext.defaultParallelism)
    rows = arrow_map(numbered.coalesce(tasks), work, "block long, counters binary", BATCH_ROWS)
    out = np.zeros((1 << (bits - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    for r in rows.groupBy("block").applyInArrow(summed, "block long, marks binary").collect():
        out[r["block"]] = np.frombuffer(bytes(r["marks"]), np.uint8)
    return out.ravel()


def _edges(numbered: DataFrame, seed: int, shared: dict, width: int, least: int) -> DataFrame:
    """w1 .. w<width>, c: summed edges (all words set) and ends (zeros at the end)
    of ``least`` words or more."""
    names = [f"w{k + 1}" for k in range(width)]

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        found, c = (summed_grams(*map(np.concatenate, zip(*held))) if held
                    else summed_grams(np.empty((0, width), np.uint64)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(found[:, k]).view(np.int64)) for k in range(width)]
            + [pa.array(c.astype(np.int64))], [*names, "c"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, bits = _read_shared(shared)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for lang, words, ids in _read_numbered(batches):
            words = frequent_words(word_hashes(words, lang, seed), frequent)[ids]
            rows = grams(words, bits, width)
            held.append(summed_grams(rows[rows[:, least - 1] != 0]))
            if sum(len(c) for _, c in held) > HELD:
                yield summed(held)
                held = []
        yield summed(held)

    rows = arrow_map(numbered, work, ", ".join(f"{c} long" for c in [*names, "c"]), BATCH_ROWS)
    return rows.groupBy(*names).agg(F.sum("c").alias("c"))


def _short_ends(edges: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """words, c: the ends of one and two words: how often a frequent word (``words``: h, c)
    or pair occurs, less what goes on from there: pairs, and edges and ends of more words."""
    def left(known: DataFrame, on: DataFrame, names: list[str]) -> DataFrame:
        gone = on.select(*names, (-F.col("c")).alias("c"))
        return (known.select(*names, "c").unionByName(gone).groupBy(*names).agg(F.sum("c").alias("c"))
                .filter("c <> 0").select(F.array(*names).alias("words"), "c"))

    return left(pairs, edges, ["w1", "w2"]).unionByName(left(words.withColumnRenamed("h", "w1"), pairs, ["w1"]))


def compact_paths(paths: DataFrame, inner: DataFrame, rounds: int, width: int) -> DataFrame:
    """Paths (words, c) with the nodes of ``inner`` (node) joined away where a
    coin falls right: a path that ends in a picked node is joined to the one
    that starts there, unless it starts in a picked node itself."""
    nodes = width - 1
    for i in range(rounds):
        picked = inner.filter(F.pmod(F.xxhash64(F.lit(i), "node"), F.lit(2)) == 0)
        head, tail = F.slice("words", 1, nodes), F.slice("words", -nodes, nodes)
        marked = (paths.withColumns({"head": head, "tail": tail})
                  .join(picked.select(F.col("node").alias("head"), F.lit(True).alias("from_picked")), "head", "left")
                  .join(picked.select(F.col("node").alias("tail"), F.lit(True).alias("to_picked")), "tail", "left")
                  .select("words", "c", "head", "tail", F.coalesce("from_picked", F.lit(False)).alias("from_picked"),
                          F.coalesce("to_picked", F.lit(False)).alias("to_picked")))
        marked = stage(marked, "phrase-marked")
        left = marked.filter("to_picked and not from_picked")
        right = marked.filter("from_picked").select(F.col("head").alias("tail"), F.col("words").alias("more"))
        joined = left.join(right, "tail").select(
            F.concat("words", F.slice("more", nodes + 1, F.size("more"))).alias("words"), "c")
        # what follows a picked node that nothing was joined at
        lone = marked.filter("from_picked").join(left.select(F.col("tail").alias("head")), "head", "left_anti")
        rest = marked.filter("not from_picked and not to_picked").unionByName(lone).select("words", "c")
        paths = stage(joined.unionByName(rest), "phrase-paths")
    return paths


def phrase_graph(docs: DataFrame, lang_col: str, text_col: str, min_count: int, max_words: int,
                 rounds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vocabulary (lang, word, h, c), compacted paths (words, c) and the piece
    ends (words, c) of fewer than ``max_words`` words."""
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text_col).cast("string").alias("text")).filter("length(text) > 0")
    numbered = stage(_numbered(slim), "phrase-numbers", **ROW_GROUPS)
    seed = 0
    while True:
        vocabulary = stage(_vocabulary(numbered, seed), "phrase-words")
        shared = vocabulary.groupBy("h").agg(F.count("*").alias("words"), F.max("c").alias("c"))
        if shared.filter((F.col("words") > 1) & (F.col("c") >= min_count)).isEmpty():
            break
        seed += 1
    def share(bits: np.ndarray):
        return spark.sparkContext.broadcast(bits.tobytes())
    frequent = vocabulary.filter(F.col("c") >= min_count)
    shared = {1: share(np.sort(frequent.select("h").toArrow().column("h").to_numpy()))}
    counted = max_words > 2       # pairs by a scan of their own, so edges of three words or more
    if counted:
        pairs = stage(_frequent_pairs(numbered, seed, shared, min_count), "phrase-pairs")
        shared = shared | {2: share(_filter_bits(pairs, "h"))}
    least = max(1, min_count)
    bits = counter_bits(vocabulary.agg(F.sum("c")).first()[0] or 0, least)
    for size in FILTERS[1:]:
        if size < max_words:
            shared = shared | {size: share(_frequent_places(numbered, seed, shared, size, least, bits))}

    names = [f"w{k + 1}" for k in range(max_words)]
    edges = stage(_edges(numbered, seed, shared, max_words, 3 if counted else 1), "phrase-edges")
    whole = edges.filter(f"{names[-1]} <> 0").select(F.array(*names).alias("words"), "c")
    ends = edges.filter(f"{names[-1]} = 0").select(F.filter(F.array(*names), lambda w: w != 0).alias("words"), "c")
    if counted:
        ends = ends.unionByName(stage(_short_ends(edges, pairs, frequent), "phrase-ends"))
    if max_words < 3 or not rounds:
        return vocabulary, whole, ends
    # flow into and out of the nodes: what leaves and ends there, and what enters
    node = max_words - 1
    out = whole.select(F.slice("words", 1, node).alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"),
                       "c", F.lit(0).cast("long").alias("entered"))
    into = whole.select(F.slice("words", 2, node).alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in"),
                        F.lit(0).cast("long").alias("c"), F.col("c").alias("entered"))
    ended = ends.filter(F.size("words") == node).select(
        F.col("words").alias("node"), F.lit(2).alias("out"), F.lit(0).alias("in"), "c",
        F.lit(0).cast("long").alias("entered"))
    # one edge in, one out, no piece end, and as much flow in as out: no piece start
    inner = (out.unionByName(into).unionByName(ended).groupBy("node")
             .agg(*[F.sum(c).alias(c) for c in ("out", "in", "c", "entered")])
             .filter("out = 1 and `in` = 1 and c = entered").select("node"))
    return vocabulary, compact_paths(whole, stage(inner, "phrase-inner"), rounds, max_words), ends


def gram_counts(paths: DataFrame, ends: DataFrame, max_words: int) -> DataFrame:
    """words, f: the count of every gram of 1 to ``max_words`` words that no
    filter has cut; each level from the flow of the one above and its piece ends."""
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - max_words + 1)).alias("i")
    level = stage(paths.select("words", "c", starts).select(
        F.slice("words", F.col("i"), F.lit(max_words)).alias("words"), F.col("c").alias("f")), "phrase-level")
    levels = [level]
    for k in range(max_words - 1, 0, -1):
        flow = level.select(F.slice("words", 1, k).alias("words"), "f")
        stop = ends.filter(F.size("words") == k).select("words", F.col("c").alias("f"))
        level = stage(flow.unionByName(stop).groupBy("words").agg(F.sum("f").alias("f")), "phrase-level")
        levels.append(level)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _first_ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language, with ``rank``.  While many rows
    are left, each language's are ranked in salted groups first."""
    from pyspark.sql import Window

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    while (n := rows.count()) > max(GROUP_ROWS, 2 * top):
        salt = F.pmod(F.xxhash64("phrase"), F.lit(max(2, n // GROUP_ROWS)))
        ranked = rows.withColumn("salt", salt).withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        left = stage(ranked.filter(F.col("rank") <= top).drop("rank", "salt"), "phrase-ranked")
        if left.count() > n // 2:       # many languages: groups are small as they are
            rows = left
            break
        rows = left
    own = Window.partitionBy("lang").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(own).cast("long")).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, rounds: int = ROUNDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top``
    phrases of 2 to ``max_words`` words that occur ``min_count`` times, by their
    lowest-scoring cut."""
    vocabulary, paths, ends = phrase_graph(docs, lang_col, text_col, min_count, max_words, rounds)
    counts = stage(gram_counts(paths, ends, max_words).filter(F.col("f") >= min_count), "phrase-counts")
    totals = vocabulary.groupBy("lang").agg(F.sum("c").alias("n"))

    # phrases inside a longer one of the same count: one word longer is enough,
    # since counts only fall on the way
    size = F.size("words")
    longer = counts.filter(size > 2)
    inside = (longer.select(F.slice("words", 1, size - 1).alias("words"), F.col("f").alias("g"))
              .unionByName(longer.select(F.slice("words", 2, size - 1).alias("words"), F.col("f").alias("g")))
              .groupBy("words").agg(F.max("g").alias("g")))
    phrases = (counts.filter(size > 1).join(inside, "words", "left")
               .filter("g is null or g < f").select("words", F.col("f").alias("a")))
    phrases = stage(phrases, "phrase-candidates")

    cuts = phrases.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("first"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    left = counts.select(F.col("words").alias("first"), F.col("f").alias("l"))
    right = counts.select(F.col("words").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, "first").join(right, "rest").select("words", "a", "k", "l", "r")

    # a phrase's words, from its hashes
    words = phrases.select("words", F.posexplode("words").alias("pos", "h"))
    named = (words.join(vocabulary.select("h", "lang", "word"), "h").groupBy("words")
             .agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("named"))
             .select("words", "lang", F.array_join(F.col("named.word"), " ").alias("phrase")))
    exact = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    scored = cuts.join(named, "words").join(totals, "lang").withColumns({f"{c}_": v for c, v in exact.items()})
    score = F.expr("(cast(1000 as decimal(4,0)) * a_ * n_) div (l_ * r_)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "n")).alias("b")
    rows = stage(scored.groupBy("lang", "phrase").agg(best)
                 .select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score"), "phrase-scored")
    return _first_ranked(rows, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
