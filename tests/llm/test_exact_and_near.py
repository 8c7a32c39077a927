"""Exact and near duplicates against brute force and SQL."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from tablesync.llm import near_dup as N
from tablesync.llm import queries as Q
from tablesync.llm.components import components
from tablesync.llm.exact_dup import drop_copies, exact_groups

from .conftest import EDGE_ROWS, SF_SMALL


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.oracles()))
def test_query_matches_sql(spark, duck, name):
    got = Q.registry()[name](spark, SF_SMALL)
    want = duck.sql(Q.oracles()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_exact_groups_edges(edge_docs):
    rows = exact_groups(edge_docs, digest_all=True).collect()
    assert len(rows) == len(EDGE_ROWS)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["keep_id"] == 1 and by[2][0]["keep_id"] == 1 and by[1][0]["group_size"] == 2
    assert by[3][0]["group_size"] == 1        # one blank is not nothing
    assert by[None][0]["keep_id"] is None and by[None][0]["kept"]
    assert sorted(r["kept"] for r in by[4]) == [False, True]
    for r in rows:
        if r["doc_id"] == 7:
            assert r["text_sha256"] == hashlib.sha256(_norm(EDGE_ROWS[-1][1]).encode()).hexdigest()


def test_exact_groups_digests_only_survivors(docs_of):
    docs = docs_of([(1, "a  b"), (2, "a b"), (3, "other")])
    rows = {r["doc_id"]: r for r in exact_groups(docs).collect()}
    assert rows[1]["text_sha256"] == rows[2]["text_sha256"] is not None
    assert rows[3]["text_sha256"] is None and rows[3]["kept"]


def test_one_bucket_changes_nothing(docs_of):
    docs = docs_of([(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)])
    a = exact_groups(docs, digest_all=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    b = exact_groups(docs, digest_all=True, buckets=1).select(a.columns)
    assert sorted(a.collect()) == sorted(b.collect())


def test_drop_copies_keeps_columns(edge_docs, no_docs):
    left = drop_copies(edge_docs)
    assert left.columns == edge_docs.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 3, 4, 5, 6, 7]
    assert drop_copies(no_docs).count() == 0


def test_exact_empty(no_docs):
    assert exact_groups(no_docs).count() == 0


# --- near duplicates -------------------------------------------------------

def _sets(rows):
    out = {}
    for i, t in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", w) if x]
        out[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    return out


def _brute(rows):
    sets = _sets(rows)
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_brute_force(docs_of):
    rng = random.Random(3)
    rows, i = [], 0
    shared = [f"s{rng.randrange(999)}" for _ in range(40)]
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(3, 150))]
        if rng.random() < 0.4:
            base += shared
        for _ in range(rng.randint(1, 8)):
            i += 1
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(9999)}"
            rows.append((i, (" ".join(text)).upper() if rng.random() < 0.3 else "\t".join(text)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(docs_of(rows)).collect()}
    assert got == _brute(rows)


def test_blocks_change_nothing(docs_of, monkeypatch):
    """A group larger than a block is dealt in pairs of blocks."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(120)] = f"x{rng.randrange(99)}"
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(N, "BLOCK", 7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(docs_of(rows)).collect()}
    assert got == _brute(rows)


def test_near_duplicates_edges(edge_docs, no_docs):
    rows = N.near_duplicates(edge_docs).collect()
    assert len(rows) == len(EDGE_ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert [(by[i]["n_shingles"], by[i]["component_id"], by[i]["kept"]) for i in (1, 2, 3)] == [
        (0, 1, True), (0, 2, True), (0, 3, True)]
    assert by[4]["n_shingles"] == 1 and by[4]["component_id"] == 4
    assert by[5]["n_shingles"] == 1 and not by[None]["kept"] and by[None]["component_id"] is None
    assert N.near_duplicates(no_docs).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    a, b = x[:2000], x[500:]                       # similarity 1500 / 3000
    assert (N.merge_registers(N.registers(a), N.registers(b)) == N.registers(x)).all()
    ra, rb = N.registers(a), N.registers(b)
    args = (np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([2000.0]), np.array([2500.0]))
    assert N.may_link(*args, threshold=0.5).all()
    assert not N.may_link(*args, threshold=0.79).any()


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["component"] for r in components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}}
    assert components(links.filter("a < 0"), "a", "b").count() == 0


def test_recall_just_above_the_threshold():
    """10,000 planted pairs at similarity 0.75 to 0.80 share a band and pass the
    likelihood test (registers come from one hash and a multiplier each)."""
    rng = np.random.default_rng(9)
    missed = unlikely = 0
    for _ in range(10_000):
        shared = int(rng.integers(60, 120))
        alone = int(np.floor(shared * (1 / rng.uniform(0.75, 0.80) - 1)))       # shared / (shared + alone) >= 0.75
        left = int(rng.integers(0, alone + 1))
        if 100 * (shared + min(left, alone - left)) < 75 * (shared + max(left, alone - left)):
            left = alone // 2
        x = rng.integers(1, 2**63, shared + alone, dtype=np.uint64)
        a, b = N.registers(x[:shared + left]), N.registers(np.concatenate([x[:shared], x[shared + left:]]))
        assert shared / (shared + alone) >= 0.75
        missed += not (a == b).reshape(N.BANDS, N.ROWS).all(axis=1).any()
        ok = N._agreement(a[None], b[None], np.array([shared + left]), np.array([shared + alone - left]))
        unlikely += not ok[0]
    assert missed == 0 and unlikely == 0


def test_a_family_costs_rows_in_proportion(docs_of, monkeypatch):
    """5,000 near copies: what leaders link is not dealt into blocks again."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(110)]
    rows = []
    for i in range(5000):
        text = list(base)
        text[rng.randrange(110)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    dealt, tested = [], []
    blocks, likely = N._blocks_of, N._likely_pairs
    monkeypatch.setattr(N, "_blocks_of", lambda *a: dealt.append(blocks(*a).count()) or blocks(*a))
    monkeypatch.setattr(N, "_likely_pairs", lambda p, *a: tested.append(p.count()) or likely(p, *a))
    got = N.near_duplicates(docs_of(rows))
    assert {r["component_id"] for r in got.collect()} == {0}
    assert sum(tested) < 40 * len(rows) and sum(dealt) < 4 * len(rows)
