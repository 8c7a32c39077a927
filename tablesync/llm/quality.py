"""Quality classifier: supervised subword embeddings.

A word is the mean of learned vectors of its hashed self and its hashed n-grams
of characters (code points); a document is the mean of its words; a softmax over
the mean gives the score.  One feature is added to the method: a pseudo-word
for each word that repeats the one before it, since a mean of words can't see
repetition (the README has the accuracy with and without it).
Trained by numpy stochastic gradient descent on at most ``MAX_TRAIN`` labelled
documents of together at most ``MAX_TRAIN_TOTAL`` characters, the first by a hash
of their id, long ones among them; every document is scored on its whole text.

For scoring, the output layer is folded into the vectors, so a word is one
number, worked out once per worker and then looked up.  One scan, one Arrow
pass, no shuffle; the model (a few MB, fixed size) is broadcast.

Edge cases: null and empty texts score by the bias alone; null ids and null
labels are never trained on; without any label the score is 0.5; repeated rows
give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_map, balanced

BUCKETS = 1 << 17
DIM = 8
NGRAMS = (3, 4, 5)
EPOCHS = 8
RATE = 0.3
MAX_TRAIN = 3000
MAX_TRAIN_TOTAL = 24_000_000
MAX_TRAIN_CHARS = 20_000        # of one document, where a caller bounds each (op6)
HELD_OUT_OF, HELD_OUT = 3, 1
REPEAT = b"\x00again"
WORD_MEMORY = 200_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT_OF


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words (buckets), and for each its word's place."""
    marked = [f"<{w.decode('utf-8', 'surrogatepass')}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    raw = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(marked)), lengths)
    starts = np.cumsum(lengths) - lengths
    # the word itself: a polynomial over its code points
    power = (np.arange(len(raw)) - starts[owner]).astype(np.uint64) * _M2 + _M1
    whole = np.add.reduceat((raw * (power | np.uint64(1))), starts) if len(raw) else raw[:0]
    hashes, owners = [whole * _M1 + np.uint64(7)], [np.arange(len(marked))]
    for n in NGRAMS:
        if len(raw) < n:
            continue
        inside = owner[:-n + 1] == owner[n - 1:]
        h = np.full(len(raw) - n + 1, n, np.uint64)
        for j in range(n):
            h = (h ^ raw[j:len(raw) - n + 1 + j]) * _M1
        hashes.append(h[inside])
        owners.append(owner[:-n + 1][inside])
    h = np.concatenate(hashes)
    h = ((h ^ (h >> np.uint64(29))) * _M2) >> np.uint64(40)
    order = np.concatenate(owners)
    return (h % np.uint64(BUCKETS)).astype(np.int64), order


def words_of(text: str) -> tuple[list[bytes], int]:
    """The words, and how many repeat the word before them."""
    words = text.encode("utf-8", "surrogatepass").split()
    return words, sum(map(eq, words, words[1:]))


class Model:
    def __init__(self) -> None:
        self.vectors = np.zeros((BUCKETS, DIM), np.float32)
        self.output = np.zeros((DIM, 2), np.float32)
        self.bias = np.zeros(2, np.float32)

    def folded(self) -> tuple[np.ndarray, float]:
        """A number for each bucket: its share in the log-odds of label 1."""
        return self.vectors @ (self.output[:, 1] - self.output[:, 0]), float(self.bias[1] - self.bias[0])


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their weights in its mean."""
    words, again = words_of(text)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    if again:
        counts[REPEAT] = again
    if not counts:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    idx, owner = features(list(counts))
    per = np.fromiter(counts.values(), np.float64, len(counts))
    weight = (per / (len(words) * np.bincount(owner)))[owner]
    idx, back = np.unique(idx, return_inverse=True)
    return idx, np.bincount(back, weight).astype(np.float32)


def train(texts: list[str], labels: list[int], seed: int = 1) -> Model:
    model, rng = Model(), np.random.default_rng(seed)
    bags = [_bag(t) for t in texts]
    share = (np.bincount(labels, minlength=2) + 1) / (len(labels) + 2) if labels else np.array([0.5, 0.5])
    model.bias[:] = np.log(share)
    model.vectors[:] = rng.uniform(-1 / DIM, 1 / DIM, model.vectors.shape)
    model.output[:] = rng.uniform(-0.5, 0.5, model.output.shape) if labels else 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(bags)):
            idx, w = bags[i]
            if not len(idx):
                continue
            rows = model.vectors[idx]
            mean = w @ rows
            z = mean @ model.output + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = model.output @ p
            model.output -= rate * np.outer(mean, p)
            model.bias -= 0.1 * rate * p
            # the mean moves by one step whatever the number of features
            model.vectors[idx] = rows - np.outer(w * (rate / float(w @ w)), back)
    return model


class Scorer:
    """Scores whole texts; remembers words, up to a bound."""

    def __init__(self, folded: np.ndarray, bias: float):
        self.folded, self.bias, self.known = folded, bias, {}

    def _learn(self, words: list[bytes]) -> None:
        idx, owner = features(words)
        value = np.bincount(owner, self.folded[idx]) / np.bincount(owner)
        self.known.update(zip(words, value.tolist()))

    def scores(self, texts: list[str]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        new = {w for words, _ in split for w in words}
        new.add(REPEAT)
        unseen = [w for w in new if w not in self.known]
        if len(self.known) + len(unseen) > WORD_MEMORY:
            self.known, unseen = {}, list(new)
        if unseen:
            self._learn(unseen)
        get = self.known.__getitem__
        z = np.array([self.bias + ((sum(map(get, words)) + again * get(REPEAT)) / len(words) if words else 0)
                      for words, again in split], np.float64)
        return 1 / (1 + np.exp(-z))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str,
                  max_rows: int = MAX_TRAIN, max_chars: int = MAX_TRAIN_CHARS) -> list:
    """At most ``max_rows`` (text, label), the first labelled rows outside the
    held-out fold by a hash of their id."""
    chosen = (labels.filter((fold(id_col) != HELD_OUT) & F.col(id_col).isNotNull() & F.col(label).isNotNull())
              .select(F.col(id_col).alias("l_id"), F.col(label).cast("int").alias("y"))
              .dropDuplicates(["l_id"]).orderBy(F.xxhash64("l_id"), "l_id").limit(max_rows))
    rows = (docs.select(F.col(id_col).alias("d_id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), F.col("d_id") == F.col("l_id"))
            .filter(F.length("text") <= max_chars)
            .select("l_id", "text", "y").orderBy(F.xxhash64("l_id"), "l_id", "text").limit(max_rows))
    return rows.collect()


def bounded_training_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str,
                          max_rows: int = MAX_TRAIN, max_total: int = MAX_TRAIN_TOTAL) -> list:
    """(text, label) of the first labelled rows outside the held-out fold by a
    hash of their id: at most ``max_rows`` of together at most ``max_total``
    characters, whatever the length of each.  Ids and lengths are chosen from
    first, so only chosen texts are fetched."""
    chosen = (labels.filter((fold(id_col) != HELD_OUT) & F.col(id_col).isNotNull() & F.col(label).isNotNull())
              .select(F.col(id_col).alias("l_id"), F.col(label).cast("int").alias("y"))
              .dropDuplicates(["l_id"]).orderBy(F.xxhash64("l_id"), "l_id").limit(max_rows))
    texts = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("d_id") == F.col("l_id")).filter(F.col("text").isNotNull())
    order = [F.xxhash64("l_id"), "l_id", F.xxhash64("text")]
    sized = rows.select("l_id", "y", F.length("text").alias("n"), F.xxhash64("text").alias("k"), F.xxhash64("l_id").alias("o"))
    picked, total = [], 0
    for r in sized.orderBy("o", "l_id", "k").limit(max_rows).collect():
        if total + r["n"] <= max_total:
            total += r["n"]
            picked.append((r["l_id"], r["k"]))
    if not picked:
        return []
    wanted = docs.sparkSession.createDataFrame(
        picked, f"p_id {chosen.schema['l_id'].dataType.simpleString()}, p_key long").distinct()
    rows = rows.join(F.broadcast(wanted), (F.col("l_id") == F.col("p_id")) & (F.xxhash64("text") == F.col("p_key")))
    return rows.select("l_id", "text", "y").orderBy(*order).limit(len(picked)).collect()


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """``docs`` rows as ``row`` (a struct of all columns), ``score`` and
    ``predicted``."""
    got = bounded_training_rows(docs, labels, label, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(
        train([r["text"] for r in got], [r["y"] for r in got]).folded())
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(text_col).cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for part, texts in balanced(batches, "text"):
            s = scorer.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["row", "score", "predicted"])

    return arrow_map(packed, score, f"row {packed.schema['row'].dataType.simpleString()}, "
                     "score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score``, ``predicted``."""
    slim = docs.select(F.col(id_col), F.col(text_col))
    scored = score_quality(slim, labels, id_col, text_col).select("row.*", "score", "predicted")
    return scored.select(id_col, F.coalesce(fold(id_col) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the classifier rejects, columns as given."""
    return score_quality(docs, labels, id_col, text_col).filter("predicted = 1").select("row.*")
