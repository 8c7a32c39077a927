"""URL filter: explicit host and path rules first, a trained model for the rest.

The model is a logistic regression on hashed character n-grams of host and
path, trained by numpy gradient descent on the small labelled table of
``url_table`` (where the job is planned, about a second).  Rules are column expressions; the
longest that fits wins.  One scan, one Arrow pass, no shuffle.

A url's n-grams are a set, so a very long path costs time in proportion; ties of
rules of one length go to the one listed first.

Edge cases: a null url, or one without ``://``, has an empty host and path and
no rule; a null id stays null; repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_map, lower_ascii
from tablesync.llm.url_table import LABELLED

BUCKETS = 1 << 15
NGRAMS = (3, 4, 5)
EPOCHS, RATE, DECAY = 600, 1.0, 1e-4
HOST_SHARE = 2.0

Rule = tuple[str, str, str]


def _ngrams(host: str, path: str) -> tuple[list[int], list[int]]:
    """Hashed n-grams of the host and of the path, each a set."""
    def grams(kind: str, text: str) -> list[int]:
        found = {kind + text[i:i + n] for n in NGRAMS for i in range(len(text) - n + 1)}
        return sorted({zlib.crc32(g.encode()) % BUCKETS for g in found})
    return grams("h", f"^{host}$"), grams("p", f"^{path}$")


def _scaled(host: str, path: str) -> tuple[list[int], np.ndarray]:
    """Features and their weights: host and path count alike whatever their
    lengths, the host for more."""
    h, p = _ngrams(host, path)
    return h + p, np.concatenate([np.full(len(h), HOST_SHARE / np.sqrt(len(h) or 1), np.float32),
                                  np.full(len(p), 1 / np.sqrt(len(p) or 1), np.float32)])


def train(labelled=LABELLED) -> np.ndarray:
    """Weights by hashed n-gram, the bias last (full-batch gradient descent)."""
    # each host alone as well: it has to be judged whatever page of it is asked for
    rows = [row for u, y in labelled for host, _, path in [u.partition("/")] for row in ((host, path, y), (host, "", y))]
    x = np.zeros((len(rows), BUCKETS + 1), np.float32)
    for r, (host, path, _) in zip(x, rows):
        idx, share = _scaled(host.lower(), "/" + path)
        np.add.at(r, idx, share)
        r[-1] = 1
    used = np.append(x[:, :-1].any(axis=0), True)
    x = np.ascontiguousarray(x[:, used])        # few of the buckets hold an n-gram of the table
    y = np.array([r[2] for r in rows], np.float32)
    v = np.zeros(x.shape[1], np.float32)
    for _ in range(EPOCHS if len(rows) else 0):
        p = 1 / (1 + np.exp(-x @ v))
        v -= RATE * (x.T @ (p - y) / len(y) + DECAY * v)
    w = np.zeros(BUCKETS + 1, np.float32)
    w[used] = v
    return w


def block_score(host: str, path: str, w: np.ndarray) -> float:
    idx, share = _scaled(host, path)
    return float(1 / (1 + np.exp(-(float(w[idx] @ share) + w[-1]))))


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return (lower_ascii(F.coalesce(F.regexp_extract(url, part, 1), F.lit(""))),
            F.coalesce(F.regexp_extract(url, part, 2), F.lit("")))


def _fits(host: Column, path: Column, rule: Rule) -> Column:
    _, rule_host, rule_path = rule
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
               threshold: float = 0.5, labelled=LABELLED) -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule`` (null where none fits),
    ``verdict`` (allow or block) and ``block_score`` (the model's).

    ``rules`` are (verdict, host, path prefix); each fits its host and all
    subdomains."""
    weights = pages.sparkSession.sparkContext.broadcast(train(labelled))
    host, path = host_and_path(F.col(url_col).cast("string"))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    id_type = parts.schema["id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            score = [block_score(h, p, w) for h, p in
                     zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "block_score"])

    out = arrow_map(parts, scored, f"id {id_type}, host string, path string, block_score double")
    rule = verdict = None
    for r in sorted(rules, key=lambda r: len(r[1] + r[2]), reverse=True):
        fit = _fits(F.col("host"), F.col("path"), r)
        name = F.lit(r[1] + r[2])
        rule = F.when(fit, name) if rule is None else rule.when(fit, name)
        verdict = F.when(fit, F.lit(r[0])) if verdict is None else verdict.when(fit, F.lit(r[0]))
    model = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return out.select(
        F.col("id").alias(id_col), "host", "path",
        (F.lit(None).cast("string") if rule is None else rule).alias("rule"),
        (model if verdict is None else verdict.otherwise(model)).alias("verdict"), "block_score")
