"""Best-fit packing with exact-complement hashing.

Texts become token ids (each ends with one end id) and pieces of at most
``seq_len`` ids; only longer texts are cut, and then the first piece is the
short one.  Which pieces share a sequence depends on lengths alone, so the plan
is made from the histogram of lengths (below ``seq_len`` entries, whatever the
number of pieces):

1. for each length, longest first, the gap it leaves is looked up among the
   single lengths available, then in further rounds among pair sums and triple
   sums; a combination that fills the gap exactly is consumed as often as the
   counts allow;
2. what is left goes best-fit, longest first, into the tightest open gap.

Using up small pieces in exact triples may cost more than it gains, so the plan
is also made with fewer rounds, and the one with the fewest sequences is taken.

A step takes all equal pieces at once.  Pieces get a rank within their length
(row numbers within salted parts of a length plus the parts' running counts, so
a length that a third of all pieces share is dealt to many tasks), and the rank
says which slot of the plan a piece fills.

Edge cases: null or empty text is the end id alone; a null id stays null;
repeated rows are packed each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesync.llm.bpe import encoder, read_tokenizer
from tablesync.llm.common import arrow_map, balanced, stage

SEQ_LEN = 1024
END_ID = 2
MIN_SALTS = 16
ROWS_PER_SALT = 1_000_000
RANK_BITS = 44  # of a slot key: length above, rank below


def cut(n: int, seq_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; the first may be shorter."""
    first = n % seq_len or min(n, seq_len)
    return [(0, first), *((s, seq_len) for s in range(first, n, seq_len))]


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, on request,
    ``ids`` (little-endian uint32 bytes)."""
    spec = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(spec.value, lengths_only=False)
        for part, texts in balanced(batches, "text", 1 << 20):
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, raw in enumerate(ids_of.batch(texts)):
                raw += end
                for k, (s, n) in enumerate(cut(len(raw) // 4, seq_len)):
                    own = raw[4 * s:4 * (s + n)]
                    owner.append(row)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own)
            cols = [part.column("id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return arrow_map(slim, encode, schema).withColumnRenamed("id", id_col)


class Plan:
    """Slots by length: ranks ``first``.. of a length go to sequences from
    ``base``, ``per`` to a sequence, from ``offset`` on."""

    def __init__(self) -> None:
        self.sequences = 0
        self.used: Counter[int] = Counter()
        self.slots: list[tuple[int, int, int, int, int]] = []  # length, first, base, offset, per

    def add(self, lengths: list[int], times: int) -> None:
        offset = 0
        for n, per in sorted(Counter(lengths).items(), reverse=True):
            self.slots.append((n, self.used[n], self.sequences, offset, per))
            self.used[n] += per * times
            offset += n * per
        self.sequences += times


def _often(avail: np.ndarray, *parts) -> np.ndarray:
    """How often combinations of lengths can be taken, one combination a place."""
    parts = np.broadcast_arrays(*parts)
    return np.minimum.reduce([avail[p] // sum((q == p).astype(np.int64) for q in parts) for p in parts])


def _complement(avail: np.ndarray, n: int, gap: int, parts: int) -> tuple[list[int], int]:
    """``parts`` lengths that with ``n`` fill a sequence: those that can be
    taken most often; and how often."""
    if parts == 0:
        return ([n], int(avail[n])) if gap == 0 else ([], 0)
    if parts == 1:
        found = np.array([[gap]])
    elif parts == 2:
        a = np.arange(1, gap // 2 + 1)
        a = a[(avail[a] > 0) & (avail[gap - a] > 0)]
        found = np.stack([a, gap - a])
    else:
        have = np.nonzero(avail[:gap])[0]
        a, b = have[:, None], have[None, :]
        c = gap - a - b
        i, j = np.nonzero((a <= b) & (b <= c) & (c > 0) & (avail[np.maximum(c, 0)] > 0))
        found = np.stack([have[i], have[j], gap - have[i] - have[j]])
    if gap == 0 or not found.shape[1]:
        return [], 0
    k = _often(avail, n, *found)
    i = int(k.argmax())
    return [n, *map(int, found[:, i])], int(k[i])


def _plan(avail: np.ndarray, seq_len: int, depth: int) -> Plan:
    """Exact fills of up to ``depth`` complements, then best-fit."""
    avail, plan = avail.copy(), Plan()
    for parts in range(depth + 1):
        for n in range(seq_len, 0, -1):
            while avail[n]:
                lengths, times = _complement(avail, n, seq_len - n, parts)
                if not times:
                    break
                plan.add(lengths, times)
                for x in lengths:
                    avail[x] -= times
    # best-fit of the rest: bins with the same content are one entry
    gaps: dict[int, list[tuple[list[int], int]]] = {}
    for n in range(seq_len, 0, -1):
        left = int(avail[n])
        while left:
            gap = min((g for g in gaps if g >= n and gaps[g]), default=None)
            content, bins = gaps[gap].pop() if gap else ([], left)
            room = gap or seq_len
            per = min(room // n, left)
            use = min(bins, left // per)
            if use < bins and gap:
                gaps[gap].append((content, bins - use))
            gaps.setdefault(room - per * n, []).append((content + [n] * per, use))
            left -= per * use
    for entries in gaps.values():
        for content, bins in entries:
            plan.add(content, bins)
    return plan


def make_plan(counts: dict[int, int], seq_len: int = SEQ_LEN) -> Plan:
    """The plan with the fewest sequences, over how many complements an exact
    fill may have (three at most, none: best-fit alone)."""
    avail = np.zeros(seq_len + 1, np.int64)
    for n, c in counts.items():
        avail[n] += c
    return min((_plan(avail, seq_len, depth) for depth in (3, 2, 1, 0)), key=lambda p: p.sequences)


def pack(pieces: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    pieces = stage(pieces.withColumn("no", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["c"] for r in pieces.groupBy("length").agg(F.count("*").alias("c")).collect()}
    plan = make_plan(counts, seq_len)
    salts = max(MIN_SALTS, sum(counts.values()) // ROWS_PER_SALT)

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("no"), F.lit(salts)))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("c"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = stage(parts.select("length", "salt", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base")),
                  "pieces-parts")
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("no"))
    ranked = (salted.withColumn("within", within - 1).join(parts, ["length", "salt"])
              .withColumn("rank", F.col("base") + F.col("within")).drop("salt", "base", "within", "no"))

    # the plan: bounded by the number of lengths, not of pieces
    slots = np.array(sorted(plan.slots), np.int64).reshape(-1, 5)
    shared = pieces.sparkSession.sparkContext.broadcast(slots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        keys = (slots[:, 0] << RANK_BITS) + slots[:, 1]
        for batch in batches:
            n, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (n << RANK_BITS) + rank, side="right") - 1
            _, first, base, offset, per = slots[at].T
            t = rank - first
            cols = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            cols |= {"sequence_id": pa.array(base + t // per), "offset": pa.array(offset + t % per * n)}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank"]
    return arrow_map(ranked, place, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset and, on request, ids."""
    out = pack(token_pieces(docs, tokenizer_path, id_col, text_col, seq_len, end_id, with_ids), seq_len)
    return out.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                      *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ``ids`` (little-endian
    uint32 bytes).  ``packed`` has ``ids``; a sequence holds ``seq_len`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(
        F.unhex(F.array_join(parts["ids"], "")).alias("ids"))
