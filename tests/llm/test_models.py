"""Trained operators by held-out accuracy; decontamination matches; pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tablesync.llm import toxicity as toxicity_module
from tablesync.llm.decontaminate import build_index, contamination, find_matches, item_words
from tablesync.llm.quality import keep_good, quality_scores
from tablesync.llm.toxicity import CHAIN, toxicity

from .conftest import EDGE_ROWS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")}


def test_quality_held_out(tables):
    rows = quality_scores(tables["documents"], tables["labels"]).join(tables["labels"], "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.93


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels, "doc_id", "left_semi")
    rows = toxicity(docs, labels).join(labels.withColumnRenamed("toxic", "label"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum(r["toxic"] == bool(r["label"]) for r in held) / len(held) > 0.95
    clean = [r for r in held if not r["label"]]
    assert sum(r["toxic"] for r in clean) / len(clean) < 0.03


def test_toxicity_categories_reach_every_language():
    """Categories come from the training rows: no language is left without."""
    read = {t: pq.read_table(f"/root/testdata/sf0.1/{t}.parquet").to_pylist() for t in ("documents", "labels")}
    docs = {r["doc_id"]: r for r in read["documents"]}
    train, held = [], []
    for r in read["labels"]:
        d = docs[r["doc_id"]]
        (held if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 else train).append((d["text"], r["toxic"], d["lang"]))
    train = [x for x in train if len(x[0]) <= 20_000]
    chain = toxicity_module.train([x[0] for x in train], [x[1] for x in train])
    p = chain.probabilities([x[0] for x in held])
    for lang in {x[2] for x in held}:
        named = [p[i, :-1].max() >= 0.5 for i, x in enumerate(held) if x[1] and x[2] == lang]
        assert sum(named) / len(named) > 0.4, lang


def test_toxicity_groups_hold_every_toxic_row():
    rows = [np.array(r, np.int64) for r in ([0, 1], [0, 1], [2, 3], [3, 2], [4], [], [5], [5])]
    toxic = np.array([1, 1, 1, 1, 1, 1, 0, 0.0])
    labels = toxicity_module._groups(rows, toxic, 6)
    assert len(labels) == len(CHAIN) - 1 and (sum(labels) == toxic).all()
    assert all(g[0] == g[1] and g[2] == g[3] and g[0] + g[2] < 2 for g in labels)


def test_models_edges(spark, edge_docs, no_docs, tables):
    none = tables["labels"].filter("doc_id < 0")
    rows = quality_scores(edge_docs, none).collect()
    assert len(rows) == len(EDGE_ROWS) and all(r["score"] == 0.5 for r in rows)
    assert quality_scores(no_docs, none).count() == 0
    rows = toxicity(edge_docs, none).collect()
    assert len(rows) == len(EDGE_ROWS) and not any(r["toxic"] for r in rows)
    assert [c for c in rows[0].asDict() if c.startswith("p_")] == [f"p_{c}" for c in CHAIN]
    assert toxicity(no_docs, none).count() == 0
    kept = keep_good(edge_docs, none)
    assert kept.columns == edge_docs.columns and kept.schema == edge_docs.schema


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"


@pytest.fixture()
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, "short item"), (3, None), (4, "..."), (None, "nameless thing")],
                                 "item_id long, text string")


def test_contamination(docs_of, items, no_docs):
    docs = docs_of([(1, f"before {ITEM.upper()} after"), (2, ITEM.replace("eta ", "x ")), (3, "a SHORT, item! here short-item"),
                    (4, None), (5, "nameless thing"), (None, "short item"), (6, "clean"), (6, "clean")])
    got = {}
    for r in contamination(docs, items).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_hit"], r["n_items"], list(r["item_ids"]), r["contaminated"]))
    assert got == {1: [(13, 11, 1, ["1"], True)], 2: [(11, 0, 0, [], False)], 3: [(6, 4, 1, ["2"], True)],
                   4: [(0, 0, 0, [], False)], 5: [(2, 2, 1, ["null"], True)], None: [(2, 2, 1, ["2"], True)],
                   6: [(1, 0, 0, [], False)] * 2}
    assert contamination(no_docs, items).count() == 0
    assert not any(r["contaminated"] for r in contamination(docs, items.filter("item_id > 9")).collect())


def test_phrase_and_proximity_matches(docs_of, items):
    near = ITEM.replace("epsilon zeta", "zeta epsilon")       # two words trade places
    docs = docs_of([(1, ITEM), (2, near), (3, " ".join(reversed(ITEM.split())))])
    index_items = item_words(items, "item_id", "text")
    postings, terms = build_index(docs, index_items, "doc_id", "text")
    ids = {r["row"]: r["id"] for r in postings.filter("term = -1").collect()}
    kinds = {}
    for r in find_matches(postings, terms, index_items).collect():
        kinds.setdefault(ids[r["row"]], set()).add(r["kind"])
    assert kinds == {1: {"phrase"}, 2: {"proximity"}}


def _brute_near(text, item, slack=3, window=10):
    """Whether some window has 0.8 of its words within ``slack`` of a diagonal."""
    n = min(window, len(item))
    places = {}
    for i, w in enumerate(text):
        places.setdefault(w, []).append(i)
    for s in range(len(item) - n + 1):
        for d in range(-len(item) - slack, len(text) + slack):
            got = sum(any(abs(p - d - q) <= slack for p in places.get(item[q], ())) for q in range(s, s + n))
            if got >= -(-n * 8 // 10):
                return True
    return False


def test_proximity_equals_brute_force(spark, docs_of):
    """Replaced rarest words, words put in between and left out, by every window."""
    rng = random.Random(6)
    lists = [ITEM.split(), ITEM.split()[:10], "one two three four five".split(), "short item".split(),
             [f"v{rng.randrange(30)}" for _ in range(90)], [f"v{rng.randrange(60)}" for _ in range(140)]]
    texts = [[f"v{rng.randrange(60)}" for _ in range(rng.randint(20, 200))] for _ in range(10)]
    for item in lists:
        for _ in range(12):
            t, at = list(item), rng.randrange(max(1, len(item) - 12))
            t = t[at:at + rng.randint(8, 25)]
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(t) + 1)
                t[at:at + rng.randint(0, 1)] = rng.choice([[], [f"new{rng.randrange(99)}"], [rng.choice(ITEM.split())]])
            texts.append([f"v{rng.randrange(60)}" for _ in range(rng.randint(0, 9))] + t)
    texts += [ITEM.split()[:5] + ["put", "in"] + ITEM.split()[5:], [*ITEM.split()[:2], "other", *ITEM.split()[3:]]] * 3
    items = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lists)], "item_id long, text string")
    docs = docs_of([(i, " ".join(t)) for i, t in enumerate(texts)])
    got = {r["doc_id"]: {int(x) for x in [*r["item_ids"], *r["near_item_ids"]]}
           for r in contamination(docs, items, proximity=True).collect()}
    assert got == {i: {k for k, item in enumerate(lists) if _brute_near(t, item)} for i, t in enumerate(texts)}
    only = {r["doc_id"]: r["near_item_ids"] for r in contamination(docs, items, proximity=True)
            .filter("not contaminated and size(near_item_ids) > 0").collect()}
    assert "0" in only[len(texts) - 1] and "0" in only[len(texts) - 2]


def test_pipeline_stages(spark, tables):
    """Each stage against a plain version of its decisions."""
    docs = tables["documents"]
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns
    good = stages["quality"](spark, docs, SF)
    verdicts = {r["doc_id"]: r["predicted"] for r in quality_scores(docs, tables["labels"]).collect()}
    kept = [r["doc_id"] for r in good.collect()]
    assert good.columns == columns and sorted(kept) == sorted(i for i, p in verdicts.items() if p)

    single = stages["exact_dedup"](spark, docs, SF)
    first = {}
    for r in sorted(docs.collect()):
        first.setdefault(" ".join(r["text"].split()), r["doc_id"])
    got = sorted(r["doc_id"] for r in single.collect())
    assert single.columns == columns and got == sorted(first.values())

    from tablesync.llm.queries import op5_decontamination, op8_near_duplicates
    near = stages["near_dedup"](spark, docs, SF)
    assert near.columns == columns
    assert {r["doc_id"] for r in near.collect()} == {
        r["doc_id"] for r in op8_near_duplicates(spark, SF).filter("kept").collect()}
    clean = stages["decontaminate"](spark, docs, SF)
    assert clean.columns == columns
    assert {r["doc_id"] for r in clean.collect()} == {
        r["doc_id"] for r in op5_decontamination(spark, SF).filter("not contaminated").collect()}


def test_pipeline_runs_whole_and_on_odd_rows(spark, edge_docs, no_docs):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
    for name, step in corpus_pipeline.STAGES:
        for docs in (edge_docs, no_docs):
            got = step(spark, docs, "/root/testdata/sf0.001")
            got.collect()
            if name != "packing":
                assert got.columns == docs.columns
    assert public_tokenizers.path("byte_bpe_50k.json")
