"""Toxicity by a classifier chain.

Binary logistic regressions on a document's words, one per category, in a
fixed order: each later model also sees the probabilities of the earlier ones.
For training, those come from out-of-fold predictions (each part is predicted
by models that have not seen it), so a later model meets them as it will in
use.  The last category is the label ``toxic`` itself; the ones before it are
groups of the toxic training documents, found in these alone: spherical k-means
on the features that tell toxic from other documents.  Every toxic training
document is in one group, whatever its language; groups are numbered by size.

Trained by numpy on at most ``MAX_TRAIN`` labelled documents, the first by a
hash of their id outside the held-out fold (``quality.fold``).  Features are
words and their beginnings: of those in ``MIN_DOCS`` training documents at
least the ``MAX_FEATURES`` that tell toxic from other documents best, so the
model is bounded.
Every document is scored on its whole text.  One scan, one Arrow pass.

Edge cases: null and empty texts score by the biases alone; without labels
every probability is the prior 0; null ids stay null; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_map, balanced
from tablesync.llm.quality import training_rows

GROUPS = 5
CATEGORIES = tuple(f"group_{i + 1}" for i in range(GROUPS))
FINAL = "toxic"
CHAIN = (*CATEGORIES, FINAL)
MAX_TRAIN = 8000
MIN_DOCS = 5
MAX_FEATURES = 2048
PREFIXES = (3, 4, 5, 6)
FOLDS = 3
# toxic documents that a group may start from; rounds of k-means
STARTS, ROUNDS = 512, 20
STEPS, RATE, PENALTY = 250, 1.0, 1e-6
WORD_MEMORY = 150_000
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, which inflected forms share."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)]


class _Rows:
    """Binary features by row, and dense columns beside them."""

    def __init__(self, rows: list[np.ndarray], width: int, dense: np.ndarray):
        self.cols = np.concatenate([*rows, np.empty(0, np.int64)])
        self.lens = np.array([len(r) for r in rows], np.int64)
        self.owner = np.repeat(np.arange(len(rows)), self.lens)
        self.rows, self.width, self.dense = rows, width, dense

    def take(self, keep: np.ndarray) -> _Rows:
        return _Rows([self.rows[i] for i in np.nonzero(keep)[0]], self.width, self.dense[keep])

    def dot(self, w: np.ndarray) -> np.ndarray:
        z = np.bincount(self.owner, w[self.cols], len(self.rows))
        return z + self.dense @ w[self.width:-1] + w[-1]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.cols, r[self.owner], self.width), r @ self.dense, [r.sum()]])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(x: _Rows, y: np.ndarray) -> np.ndarray:
    """Weights, the bias last: full-batch gradient descent, step sizes by the
    past gradients of each weight."""
    w = np.zeros(x.width + x.dense.shape[1] + 1)
    if not len(y):
        w[-1] = -30.0
        return w
    share = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(share / (1 - share))
    if y.min() == y.max():
        return w
    past = np.full_like(w, 1e-8)
    for _ in range(STEPS):
        g = x.back(_sigmoid(x.dot(w)) - y) / len(y) + PENALTY * w
        past += g * g
        w -= RATE / 4 * g / np.sqrt(past)
    return w


class Chain:
    """``vocabulary`` (feature to column) and a weight vector per model:
    features, then the probabilities of the models before it, then the bias."""

    def __init__(self, vocabulary: dict[str, int], models: list[np.ndarray]):
        self.vocabulary, self.models = vocabulary, models
        n = len(vocabulary)
        self.weights = np.array([m[:n] for m in models], np.float64).reshape(len(models), n)
        self.known: dict[str, list[int]] = {}

    def columns(self, words: set[str]) -> list[int]:
        known, out = self.known, set()
        for w in words:
            cols = known.get(w)
            if cols is None:
                if len(known) >= WORD_MEMORY:
                    known.clear()
                cols = known[w] = [c for f in features_of(w) if (c := self.vocabulary.get(f)) is not None]
            if cols:
                out.update(cols)
        return sorted(out)

    def probabilities(self, texts: list[str]) -> np.ndarray:
        n = len(self.vocabulary)
        out = np.zeros((len(texts), len(self.models)))
        base = np.array([self.weights[:, self.columns(words_of(t))].sum(axis=1) for t in texts])
        for k, m in enumerate(self.models if len(texts) else ()):
            out[:, k] = _sigmoid(base[:, k] + out[:, :k] @ m[n:n + k] + m[-1])
        return out


def _vocabulary(bags: list[set[str]], toxic: list[int]) -> dict[str, int]:
    """Features by how far their shares in toxic and other documents are apart,
    in standard errors."""
    seen: Counter[str] = Counter()
    bad: Counter[str] = Counter()
    for bag, t in zip(bags, toxic):
        own = {f for w in bag for f in features_of(w)}
        seen.update(own)
        if t:
            bad.update(own)
    n1 = max(1, sum(toxic))
    n0 = max(1, len(toxic) - n1)

    def apart(f: str) -> float:
        p = seen[f] / (n0 + n1)
        error = math.sqrt(max(p * (1 - p), 1e-9) * (1 / n0 + 1 / n1))
        return abs(bad[f] / n1 - (seen[f] - bad[f]) / n0) / error

    score = {f: apart(f) for f, c in seen.items() if c >= MIN_DOCS}
    return {f: i for i, f in enumerate(sorted(score, key=lambda f: (-score[f], f))[:MAX_FEATURES])}


def _groups(rows: list[np.ndarray], toxic: np.ndarray, width: int) -> list[np.ndarray]:
    """A 0/1 label per category: each toxic document is in one group, of
    documents that share features commoner in toxic ones (weighted by log odds
    ratio).  Groups start from the documents that, one after the other, bring
    all others closest to a start."""
    bad = np.nonzero(toxic)[0]
    labels = [np.zeros(len(toxic)) for _ in CATEGORIES]
    if not len(bad):
        return labels
    cols = np.concatenate([*rows, np.empty(0, np.int64)])
    owner = np.repeat(toxic, [len(r) for r in rows])
    n1, n0 = np.bincount(cols[owner > 0], minlength=width), np.bincount(cols[owner == 0], minlength=width)
    clean = len(toxic) - len(bad)
    odds = (n1 + 0.5) / (len(bad) - n1 + 0.5) / ((n0 + 0.5) / (clean - n0 + 0.5))
    weight = np.maximum(np.log(odds), 0).astype(np.float32)
    x = np.zeros((len(bad), width), np.float32)
    for i, row in enumerate(bad):
        x[i, rows[row]] = weight[rows[row]]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    like = x[:STARTS] @ x.T
    best, starts = np.zeros(len(bad), np.float32), []
    for _ in CATEGORIES:
        starts.append(int(np.maximum(like - best, 0).sum(axis=1).argmax()))
        best = np.maximum(best, like[starts[-1]])
    centre = x[starts]
    for _ in range(ROUNDS):
        own = (x @ centre.T).argmax(axis=1)
        centre = np.stack([x[own == g].sum(axis=0) for g in range(GROUPS)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
    sizes = np.bincount(own, minlength=GROUPS)
    for label, g in zip(labels, np.argsort(-sizes, kind="stable")):
        label[bad[own == g]] = 1
    return labels


def train(texts: list[str], toxic: list[int]) -> Chain:
    bags = [words_of(t) for t in texts]
    vocabulary = _vocabulary(bags, toxic)
    finder = Chain(vocabulary, [])
    rows = [np.array(finder.columns(b), np.int64) for b in bags]
    y = np.array(toxic, np.float64)
    labels = [*_groups(rows, y, len(vocabulary)), y]
    part = np.arange(len(y)) % FOLDS
    x = _Rows(rows, len(vocabulary), np.zeros((len(y), 0)))
    models = []
    for label in labels:
        models.append(_fit(x, label))
        apart = np.zeros(len(y))
        for f in range(FOLDS):
            apart[part == f] = _sigmoid(x.take(part == f).dot(_fit(x.take(part != f), label[part != f])))
        x = _Rows(rows, len(vocabulary), np.hstack([x.dense, apart[:, None]]))
    return Chain(vocabulary, models)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: id, a probability ``p_<category>`` for each
    link of the chain, ``score`` (the last) and ``toxic`` (score >= threshold)."""
    got = training_rows(docs, labels, label, id_col, text_col, MAX_TRAIN)
    chain = train([r["text"] for r in got], [r["y"] for r in got])
    shared = docs.sparkSession.sparkContext.broadcast((chain.vocabulary, chain.models))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain(*shared.value)
        for part, texts in balanced(batches, "text"):
            p = model.probabilities(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *(pa.array(np.ascontiguousarray(c)) for c in p.T)],
                ["id", *(f"p_{c}" for c in CHAIN)])

    out = arrow_map(slim, score, f"id {id_type}, " + ", ".join(f"p_{c} double" for c in CHAIN))
    return out.select(F.col("id").alias(id_col), *(f"p_{c}" for c in CHAIN),
                      F.col(f"p_{FINAL}").alias("score"), (F.col(f"p_{FINAL}") >= threshold).alias("toxic"))
