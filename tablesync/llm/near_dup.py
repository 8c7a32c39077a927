"""Near-duplicates by SetSketch registers.

1. One Arrow pass gives each text its shingle set's size, fingerprint and
   registers: register i is the truncated, exponentially spaced minimum
   ``floor(1 - log_b(min_d h_i(d)))`` over the shingles, an unsigned byte.
   Registers of a union are the maxima of the parts' (``merge_registers``).
2. Texts with one shingle set form a class; one text stands for it.
3. Bands of registers put classes into buckets.  Buckets with the same members
   count once.
4. Only connectivity is wanted, so each bucket first links its members to its
   leader (the smallest): one pair a member and bucket, tested by the joint
   maximum likelihood of the two sketches (of the counts of greater, smaller and
   equal registers, given both set sizes), then confirmed on the full sets.  A
   set of thousands of near copies is connected here, in linear work.
5. Buckets whose other members are not all connected yet keep for the rest the
   pairs that differ in component: the members outside the bucket's largest component
   (the minor ones) meet all members, in blocks, a task per pair of blocks.
   Sketches pick the members that may have a partner; only those bring their full
   sets, in blocks of bounded bytes, and a task emits a spanning forest of what it
   confirms.  So no group is held whole, no pair list is written, and no pair of a
   bucket that could connect something is left out.
6. Connected components of the confirmed links.

At ``BANDS`` x ``ROWS`` registers a pair at similarity 0.75 misses every band
with probability below 1e-5 if registers are independent, and the likelihood test
drops it with probability below 1e-6; both fall steeply above 0.75 (a test plants
pairs between 0.75 and 0.80 and finds them all).

Edge cases: a null text, or one without words, has an empty set and is linked
with nothing; under five words the whole sequence is the one shingle; a null id
has a null component, its text links others all the same; repeated rows have
one component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import (
    arrow_map, balanced, broadcast_if_small, counted, parts_for, remembered, stage, text_key,
)
from tablesync.llm.components import components

SHINGLE = 5
THRESHOLD = 75          # percent
BANDS, ROWS = 64, 6
REGISTERS = BANDS * ROWS
BASE = 1.2              # registers fit a byte
BLOCK = 256             # members of a block of sketches
SET_BLOCK = 2 << 20     # bytes of full sets in a block, about
SKETCHES_PER_PART = 50_000
PAIRS_PER_PART = 32_000
KEYS_PER_PART = 2_000_000
LIKELIHOOD_RATIO = 14.0
WORD_MEMORY = 250_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
_SHIFT = np.uint64(32)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_MEMORY:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    known = remembered("word hashes", _WordHashes)
    a = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    width = min(n, SHINGLE)
    h = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        h = (h ^ a[j:n - width + 1 + j]) * _MIX[j]
        h ^= h >> _SHIFT
    return np.unique(h)


def _multipliers() -> np.ndarray:
    rng = np.random.default_rng(20240607)
    return rng.integers(1, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_A = _multipliers()


def registers(hashes: np.ndarray) -> np.ndarray:
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(low, (hashes[i:i + 512, None] * _A).min(axis=0), out=low)
    u = (low.astype(np.float64) + 1) / 2.0**64
    return np.clip(np.floor(1 - np.log(u) / np.log(BASE)), 0, 255).astype(np.uint8)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


_GRID = np.linspace(0.0, 1.0, 101)


def may_link(greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
             threshold: float = THRESHOLD / 100, ratio: float = LIKELIHOOD_RATIO) -> np.ndarray:
    """Whether the joint likelihood leaves room for a similarity of at least
    ``threshold``, from the numbers of registers that are greater or smaller
    in a than in b and the sizes of both sets."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    top = np.minimum(u, v) / np.maximum(u, v)
    g = np.minimum(_GRID[None, :], top)         # no similarity beyond the ratio of sizes
    up = np.clip(_p(np.clip(u - v * g, 0, 1)), 1e-12, 1)
    down = np.clip(_p(np.clip(v - u * g, 0, 1)), 1e-12, 1)
    # similarity J of sizes u, v: the unshared parts are (u - v J) and (v - u J)
    same = np.clip(1 - up - down, 1e-12, 1)
    equal = REGISTERS - greater - smaller
    like = greater[:, None] * np.log(up) + smaller[:, None] * np.log(down) + equal[:, None] * np.log(same)
    best = like.max(axis=1)
    high = np.where(g >= threshold - 1e-9, like, -np.inf).max(axis=1)
    return (high >= best - ratio) & (top[:, 0] >= threshold - 1e-9)


class Forest:
    """Union-find over what a task has connected; bounded by its rows."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def _agreement(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether rows of registers ``a`` and ``b`` may link, row by row."""
    ok = np.minimum(n_a, n_b) * 100 >= THRESHOLD * np.maximum(n_a, n_b)
    greater, equal = (a > b).sum(axis=1), (a == b).sum(axis=1)
    ok &= equal >= REGISTERS // 2
    if ok.any():
        at = np.nonzero(ok)[0]
        ok[at] = may_link(greater[at], REGISTERS - equal[at] - greater[at], n_a[at].astype(np.float64),
                          n_b[at].astype(np.float64))
    return ok


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold, by their full content."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < THRESHOLD * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return 100 * shared >= THRESHOLD * (len(a) + len(b) - shared)


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _likely_pairs(pairs: DataFrame, sketches: DataFrame, parts: int) -> DataFrame:
    """The pairs (x, y) that may link, by their sketches; row by row."""
    def side(c: str) -> DataFrame:
        return sketches.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("regs").alias(f"regs_{c}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                ok = _agreement(_registers_of(t.column("regs_x")), _registers_of(t.column("regs_y")),
                                t.column("n_x").to_numpy(), t.column("n_y").to_numpy())
                yield t.select(["x", "y"]).filter(pa.array(ok))

    return arrow_map(pairs.join(side("x"), "x").join(side("y"), "y").coalesce(parts), work, "x long, y long")


def _confirmed(pairs: DataFrame, sets: DataFrame, parts: int) -> DataFrame:
    """The pairs (x, y) whose full sets reach the threshold; row by row."""
    def side(c: str) -> DataFrame:
        return sets.select(F.col("rep").alias(c), F.col("set").alias(f"set_{c}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = [_linked(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
                  for a, b in zip(t.column("set_x"), t.column("set_y"))]
            yield t.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(pairs.join(side("x"), "x").join(side("y"), "y").coalesce(parts), work, "x long, y long")


def _blocks_of(members: DataFrame, minor_blocks: Column, all_blocks: Column, *carry: str) -> DataFrame:
    """Deal each group's members into pairs of blocks: ``i`` of the minor ones
    with ``j`` of all; ``role`` is 0 in a minor block, 1 in a block of all."""
    own = F.xxhash64("rep", "grp")
    keep = ("grp", "band", "rep", "comp", *carry)
    left = members.filter("minor").select(
        *keep, F.pmod(own, minor_blocks).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), (all_blocks - 1).cast("int"))).alias("j"), F.lit(0).alias("role"))
    right = members.select(
        *keep, F.explode(F.sequence(F.lit(0), (minor_blocks - 1).cast("int"))).alias("i"),
        F.pmod(own, all_blocks).cast("int").alias("j"), F.lit(1).alias("role"))
    return left.unionByName(right)


def _per_block_pair(dealt: DataFrame, fn: Callable[[pa.Table], list[tuple]], schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each pair of blocks (grp, i, j)."""
    dealt = dealt.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        out: list[tuple] = []
        key = None

        def ready() -> pa.RecordBatch:
            rows = np.array(out, np.int64).reshape(-1, len(names))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names)

        def flush() -> None:
            if held:
                out.extend(fn(pa.concat_tables(held)))
                held.clear()

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            g, i, j = (t.column(c).to_numpy() for c in ("grp", "i", "j"))
            cut = np.nonzero((g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))[0] + 1
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(g)]):
                if (k := (g[s], i[s], j[s])) != key:
                    flush()
                    key = k
                held.append(t.slice(s, e - s))
            if len(out) > 10_000:
                yield ready()
        flush()
        yield ready()

    return arrow_map(dealt, work, schema)


def _open_pairs(rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """For each minor row of a pair of blocks the rows of the other block that
    may link with it and are of another component.  Pairs that agree in a band
    before this bucket's meet there."""
    role, comp, rep, n = (rows.column(c).to_numpy() for c in ("role", "comp", "rep", "n"))
    regs = _registers_of(rows.column("regs"))
    band = rows.column("band")[0].as_py()
    right = np.nonzero(role == 1)[0]
    for x in np.nonzero(role == 0)[0].tolist():
        ys = right[(comp[right] != comp[x]) & (rep[right] != rep[x])]
        ys = ys[np.minimum(n[ys], n[x]) * 100 >= THRESHOLD * np.maximum(n[ys], n[x])]
        if band and len(ys):
            first = (regs[ys, :band * ROWS] == regs[x, :band * ROWS]).reshape(-1, band, ROWS).all(axis=2).any(axis=1)
            ys = ys[~first]
        if len(ys):
            ys = ys[_agreement(np.broadcast_to(regs[x], (len(ys), REGISTERS)), regs[ys],
                               np.full(len(ys), n[x]), n[ys])]
        if len(ys):
            yield x, ys


def _partners(rows: pa.Table) -> list[tuple]:
    """(grp, rep) of the rows that have a possible partner in these blocks."""
    found: set[int] = set()
    for x, ys in _open_pairs(rows):
        found.update(ys.tolist(), (x,))
    rep, grp = rows.column("rep").to_numpy(), rows.column("grp")[0].as_py()
    return [(grp, rep[i]) for i in found]


def _forest(rows: pa.Table) -> list[tuple]:
    """Confirmed links of these blocks that connect components, a spanning forest."""
    forest, out = Forest(), []
    comp = rows.column("comp").to_pylist()
    rep = rows.column("rep").to_pylist()
    sets = rows.column("set")
    for x, ys in _open_pairs(rows):
        a = np.frombuffer(sets[x].as_buffer(), np.uint64)
        for y in ys.tolist():
            if (forest.root(comp[x]) != forest.root(comp[y])
                    and _linked(a, np.frombuffer(sets[y].as_buffer(), np.uint64))):
                forest.join(comp[x], comp[y])
                out.append((rep[x], rep[y]))
    return out


def _blocks(total: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(total / size)).cast("int")


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_sets: bool = False) -> DataFrame:
    """id, text_key, ``n_shingles``, ``print`` (of the set), ``regs`` and, on
    request, ``set`` (sorted 64-bit hashes)."""
    slim = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    extra = ", set binary" if with_sets else ""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part, texts in balanced(batches, "text"):
            sets = [shingles(t) for t in texts]
            cols = [part.column("id"), part.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([registers(s).tobytes() if len(s) else b"" for s in sets], pa.binary())]
            names = ["id", "text_key", "n_shingles", "print", "regs"]
            if with_sets:
                cols.append(pa.array([s.tobytes() for s in sets], pa.binary()))
                names.append("set")
            yield pa.RecordBatch.from_arrays(cols, names)

    return arrow_map(slim, work, f"id {id_type}, text_key long, n_shingles long, print binary, regs binary{extra}")


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Full shingle sets of the rows that stand for a class (rep, set).  The
    rows are picked before their texts leave the scan while the list is small
    enough to broadcast."""
    slim = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    keys = broadcast_if_small(wanted.select(F.col("id").alias("w_id"), F.col("text_key").alias("w_key"), "rep"))
    picked = slim.join(keys, (F.col("text_key") == F.col("w_key")) & F.col("id").eqNullSafe(F.col("w_id")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in balanced(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("rep"), pa.array([shingles(t).tobytes() for t in texts], pa.binary())], ["rep", "set"])

    return arrow_map(picked.select("rep", "text"), work, "rep long, set binary").dropDuplicates(["rep"])


def _band_keys() -> Column:
    return F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda j: F.xxhash64(j, F.substring(F.col("regs"), j * ROWS + 1, F.lit(ROWS))))).alias("band", "key")


def _sided(rows: DataFrame, weight: Column, parts: int) -> DataFrame:
    """The rows (grp, comp, ..) of groups with several components, with
    ``minor`` (outside the group's largest component), the group's weight ``w``
    and that of its minor rows ``m``."""
    sums = rows.groupBy("grp", "comp").agg(F.sum(weight).alias("w"))
    facts = (sums.groupBy("grp").agg(F.count("*").alias("k"), F.sum("w").alias("w"),
                                      F.max(F.struct("w", "comp")).alias("major"))
             .filter("k > 1").select("grp", "w", (F.col("w") - F.col("major.w")).alias("m"),
                                     F.col("major.comp").alias("major")))
    facts = stage(facts, "sketch-sides", parts)
    return rows.join(facts, "grp").withColumn("minor", F.col("comp") != F.col("major")).drop("major")


def _links_apart(apart: DataFrame, sketches: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str,
                 text_col: str, parts: int) -> DataFrame:
    """Links (x, y) between components of buckets that hold several: the rows
    of ``_sided`` in; component pairs out, enough to connect what links."""
    def deal(rows: DataFrame, size: int) -> DataFrame:
        return _blocks_of(rows, _blocks(F.col("m"), size), _blocks(F.col("w"), size), "n", "regs")

    rows = stage(apart.join(sketches, "rep"), "sketch-sided")
    hopeful = stage(_per_block_pair(deal(rows, BLOCK), _partners, "grp long, rep long").distinct(), "sketch-hopeful")
    wanted = classes.join(hopeful.select("rep").distinct(), "rep", "left_semi").select("rep", "id", "text_key")
    sets = stage(_sets_of(docs, wanted, id_col, text_col), "sketch-sets")
    # the hopeful members alone, dealt by the bytes of their sets
    few = rows.drop("minor", "w", "m").join(hopeful, ["grp", "rep"], "left_semi")
    few = stage(_sided(few, F.col("n") * 8 + REGISTERS, parts), "sketch-few", parts)
    dealt = deal(few, SET_BLOCK).join(sets, "rep")
    links = _per_block_pair(dealt, _forest, "x long, y long")
    of = few.select("rep", "comp").distinct()
    return (links.join(of.select(F.col("rep").alias("x"), F.col("comp").alias("cx")), "x")
            .join(of.select(F.col("rep").alias("y"), F.col("comp").alias("cy")), "y")
            .select(F.col("cx").alias("x"), F.col("cy").alias("y")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links), ``kept`` (id = component_id) and
    ``text_key`` (the row's fingerprint)."""
    rows, n_rows = counted(sketch(docs, id_col, text_col), "sketch")
    first = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "text_key", "n_shingles", "regs"))
    classes = rows.filter("n_shingles > 0").groupBy("print").agg(first.alias("f"))
    classes = stage(classes.select(
        F.monotonically_increasing_id().alias("rep"), "print", "f.id", "f.text_key",
        F.col("f.n_shingles").alias("n"), "f.regs"), "sketch-classes", parts_for(n_rows, SKETCHES_PER_PART))

    # buckets by band; those with the same members count once
    banded = classes.select("rep", _band_keys())
    marked = banded.groupBy("band", "key").agg(
        F.count("*").alias("size"), F.min("rep").alias("low"), F.bit_xor(F.xxhash64("rep")).alias("x"))
    buckets = (marked.filter("size > 1").groupBy("size", "low", "x")
               .agg(F.min(F.struct("band", "key")).alias("k")))
    buckets = stage(buckets.select("k.band", "k.key", "low"), "sketch-buckets",
                    parts_for(n_rows * BANDS, KEYS_PER_PART))
    members = (banded.join(broadcast_if_small(buckets), ["band", "key"])
               .select(F.xxhash64("band", "key").alias("grp"), "band", "rep", "low"))
    members, n_members = counted(members, "sketch-members")
    sketches = classes.select("rep", "n", "regs")

    # every member with its bucket's leader
    pairs = members.filter("rep <> low").select(F.col("rep").alias("x"), F.col("low").alias("y")).distinct()
    pairs, n_pairs = counted(pairs, "sketch-pairs", parts_for(n_members, 8 * PAIRS_PER_PART))
    likely, n_likely = counted(_likely_pairs(pairs, sketches, parts_for(n_pairs, PAIRS_PER_PART)), "sketch-likely")
    ends = likely.select(F.col("x").alias("rep")).unionByName(likely.select(F.col("y").alias("rep"))).distinct()
    few = parts_for(n_likely, PAIRS_PER_PART // 8)
    sets = stage(_sets_of(docs, classes.join(ends, "rep", "left_semi").select("rep", "id", "text_key"),
                          id_col, text_col), "sketch-sets", few)
    links = stage(_confirmed(likely, sets, few), "sketch-links")
    groups = stage(components(links, "x", "y"), "sketch-groups", few)

    # what the leaders left apart; a leader has met all members of its bucket
    placed = members.filter("rep <> low").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "grp", "band", "rep", F.coalesce("component", "rep").alias("comp"))
    light = parts_for(n_members, 8 * PAIRS_PER_PART)
    apart = stage(_sided(placed, F.lit(1), light), "sketch-apart", light)
    if not apart.isEmpty():
        more = _links_apart(apart, sketches, classes, docs, id_col, text_col, light)
        # between components only: few nodes, whatever the size of the groups
        named = stage(more, "sketch-more")
        merged = components(named, "x", "y").select(F.col("node").alias("component"), F.col("component").alias("to"))
        known = groups.unionByName(named.select(F.col("x").alias("node")).unionByName(
            named.select(F.col("y").alias("node"))).distinct().join(groups, "node", "left_anti")
            .withColumn("component", F.col("node")))
        groups = stage(known.join(merged, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")), "sketch-merged", few)

    labelled = classes.select("print", F.col("id").alias("rep_id"), "rep").join(
        groups, F.col("rep") == F.col("node"), "left").select(
        "print", "rep_id", F.coalesce("component", "rep").alias("component"))
    light = parts_for(n_rows, 4 * SKETCHES_PER_PART)
    labelled = stage(labelled, "sketch-labelled", light)
    lowest = labelled.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    named = stage(labelled.join(lowest, "component").select("print", "component_id"), "sketch-named", light)
    linked = rows.join(named, "print", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return linked.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"), "text_key")
