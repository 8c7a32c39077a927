"""run() of the corpus pipeline, stage by stage, against a plain version of the
five stages chained (the classifier's verdicts are taken as given)."""

import re
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tablesync.llm.quality import quality_scores

from .conftest import SF_SMALL
from .test_exact_and_near import _brute


def _fold(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def _windows(words, n):
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _fold(text or ""))


@pytest.fixture(scope="module")
def plain(spark):
    """Kept (doc_id, text) after each of the first four stages."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    good = {r["doc_id"] for r in quality_scores(docs, labels).collect() if r["predicted"]}
    kept = {"quality": [(i, t) for i, t in rows if i in good]}
    first = {}
    for i, t in kept["quality"]:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    kept["exact_dedup"] = sorted(first.values())
    component = _brute(kept["exact_dedup"])
    kept["near_dedup"] = [(i, t) for i, t in kept["exact_dedup"] if component[i][1] == i or component[i][0] == 0]
    items = [_words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    windows = {}
    for w in items:
        if w:
            windows.setdefault(min(10, len(w)), set()).update(_windows(w, min(10, len(w))))
    kept["decontaminate"] = [(i, t) for i, t in kept["near_dedup"]
                             if not any(_windows(_words(t), n) & found for n, found in windows.items())]
    return kept


def test_stages_chained_keep_what_the_plain_version_keeps(spark, plain):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == columns, name
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(plain[name]), name


def test_run_packs_exactly_what_is_left(spark, plain):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    sequences = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(pieces) == [i for i, _ in plain["decontaminate"]]
    for i, text in plain["decontaminate"]:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            own = ids[at:at + r["length"]]
            assert (r["piece"], r["start"]) == (n, at)
            assert r["ids_crc32"] == zlib.crc32(array("I", own).tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
