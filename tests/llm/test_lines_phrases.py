"""Fill-in-middle, line dedup and phrase collocations against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.llm import collocations as C
from tablesync.llm import fill_middle as M
from tablesync.llm import line_runs as L

from .conftest import EDGE_ROWS


def _sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def _fold(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


# --- fill in the middle ----------------------------------------------------

@given(st.lists(st.integers(1, 90), max_size=700), st.data())
@settings(max_examples=60, deadline=None)
def test_unit_list_reaches_every_rank(widths, data):
    units = M.UnitList(widths)
    rank = data.draw(st.integers(0, len(widths)))
    assert units.points_before(rank) == sum(widths[:rank])


def test_unit_list_has_express_lanes():
    units = M.UnitList([3] * 5000)
    assert [len(u) for u, _ in units.lanes] == [5000, 313, 20, 2]
    assert all(sum(u) == 5000 and sum(p) == 15000 for u, p in units.lanes)


def _middle_brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, _sha(text), _sha(text)
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if h4 % 100 < 50 else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
    return n, form, len(pre), len(mid), _sha(out), _sha(text)


MIDDLE_ROWS = EDGE_ROWS + [(8, "has a <S> sentinel\ninside"), (9, "\n\n\n"), (10, "no feed at the end\nlast"),
                           (11, "almost <\nS>\n<P\n>"), (12, "🙂\nä\n中文\n" * 3000)]


def test_fill_in_middle_brute_force(docs_of, no_docs):
    out = M.fill_in_middle(docs_of(MIDDLE_ROWS))
    got = [tuple(r) for r in out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256),
        F.sha2(M.restored(), 256)).collect()]
    want = [(i, *_middle_brute(i, t)) for i, t in MIDDLE_ROWS]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert M.fill_in_middle(no_docs).count() == 0


def test_fill_in_middle_rates(docs_of):
    docs = docs_of([(i, f"a{i}\nb\nc\n") for i in range(400)])
    forms = Counter(r["form"] for r in M.fill_in_middle(docs, fim_percent=40, spm_percent=25).collect())
    assert 190 < forms["plain"] < 290 and forms["spm"] < forms["psm"]


# --- line dedup ------------------------------------------------------------

def _key(line):
    return _fold(line.strip(" \t\n\x0b\f\r"))


def _lines_brute(rows, order=lambda i: (i is None, i or 0)):
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = _key(line)
            if len(k) >= 10 and (k not in first or order(i) < order(first[k])):
                first[k] = i
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(_key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


LINE_ROWS = EDGE_ROWS + [
    (20, "A shared line here\n  unique to twenty\nA shared line here"), (8, "a SHARED line here\t\nshort\nshort"),
    (None, "a shared line here\nonly null ids hold this"), (None, "only null ids hold this"), (31, "short\nÄ shared line"),
    (32, "ä shared line\nÄ shared line"), (20, "second text of twenty\nA shared line here"),
    (33, "\n".join(f"line number {i}" for i in range(3000))), (34, "\n".join(f"Line Number {i}" for i in range(1, 4000, 3)))]


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_dedup_lines_brute_force(docs_of, batches):
    assert _rows(L.dedup_lines(docs_of(LINE_ROWS), batches=batches)) == sorted(_lines_brute(LINE_ROWS), key=repr)


def test_dedup_lines_random(docs_of):
    rng = random.Random(4)
    pool = [f"line {'x' * rng.randint(0, 9)} {i}" for i in range(60)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in rng.sample(range(900), 200)]
    assert _rows(L.dedup_lines(docs_of(rows))) == sorted(_lines_brute(rows), key=repr)


def test_dedup_lines_empty_and_text_ids(docs_of, no_docs):
    assert L.dedup_lines(no_docs).count() == 0
    rows = [(1, "the same long line"), (2, "the same long line")]
    out = L.dedup_lines(docs_of(rows).withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert sorted((r["doc_id"], r["n_dropped"]) for r in out.collect()) == [("d1", 0), ("d2", 1)]


def test_runs_are_levelled_and_continue(spark, docs_of, tmp_path):
    """Batches of separate calls meet the stored runs; runs merge like a binary counter."""
    folder = f"file://{tmp_path}/runs"
    rng = random.Random(6)
    seen = {}
    for call in range(5):
        rows = [(100 * call + i, "\n".join(f"some line {rng.randrange(80)}" for _ in range(4))) for i in range(12)]
        runs = L.LineRuns.open(spark, folder)
        got = _rows(L.dedup_lines(docs_of(rows), batches=1, runs=runs))
        want = []
        for i, t in rows:
            for k in t.split("\n"):
                seen.setdefault(k, i)
            want.append((i, 4, sum(seen[k] != i for k in t.split("\n")),
                         "\n".join(k for k in t.split("\n") if seen[k] == i)))
        assert got == sorted(want, key=repr)
        assert [len(x) for x in runs.levels] == [int(b) for b in bin(call + 1)[:1:-1]]
    assert len(L.LineRuns.open(spark, folder).runs()) == 2


def test_a_batch_that_fails_leaves_the_state(spark, docs_of, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/runs"
    docs = docs_of([(1, "one line that repeats"), (2, "one line that repeats")])
    runs = L.LineRuns.open(spark, folder)
    monkeypatch.setattr(runs, "_commit", lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.add(L.line_hashes(docs))
    again = L.LineRuns.open(spark, folder)
    assert not again.runs() and _rows(L.dedup_lines(docs, runs=again))[0][2] == 0


def test_run_joins_need_no_shuffle(spark, docs_of):
    runs = L.LineRuns(spark, buckets=4)
    for i in (1, 2):
        hits = runs.add(L.line_hashes(docs_of([(i, "one line that repeats\nanother one, of its own " + str(i))])))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "LeftAnti" in plan
    assert [(r["keep"], r["seen"]) for r in hits.collect()] == [(None, True)]


# --- collocations ----------------------------------------------------------

def _phrases_brute(rows, least, top=2000, width=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _fold(text or "")):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, width + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = []
    often = {p: c for p, c in f.items() if c >= least}
    for (lang, p), a in often.items():
        if len(p) < 2 or any(la == lang and len(q) > len(p) and c >= a and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (la, q), c in often.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(ranked)


def _docs(spark, rows):
    return spark.createDataFrame([(t, la, "x", 1) for t, la in rows], "text string, lang string, words string, c long")


def _corpus(seed=1, n=120):
    rng = random.Random(seed)
    fixed = ["new york city hall", "in spite of", "a a a a a a a", "one two three four five six seven eight nine", "Ünï çode 中文"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 30)):
            words.append(rng.choice(fixed) if rng.random() < 0.3 else f"w{rng.randrange(12)}")
            if rng.random() < 0.2:
                words.append(rng.choice([".", ", ", "\n", "!?", "\t", "\r\n", "\x0b"]))
        rows.append((" ".join(words).title() if rng.random() < 0.2 else " ".join(words), rng.choice(["en", "fr", None])))
    return rows + [(None, "en"), ("", None), (" . , ", "xx")]


def _got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,rounds", [(2, 3), (8, 0), (8, 4)])
def test_collocations_brute_force(spark, least, rounds):
    rows = _corpus()
    assert _got(C.collocations(_docs(spark, rows), min_count=least, rounds=rounds)) == _phrases_brute(rows, least)


def test_collocations_small_filters_and_groups(spark, monkeypatch):
    """Full filters cut nothing, small ranking groups and memories change nothing."""
    rows = _corpus(2, 60)
    monkeypatch.setattr(C, "GROUP_ROWS", 40)
    got = _got(C.collocations(_docs(spark, rows), min_count=2, top=15))
    assert got == _phrases_brute(rows, 2, 15)


def test_collocations_edges(spark):
    docs = _docs(spark, [])
    assert C.collocations(docs).count() == 0
    rows = [("word " * 40_000, "en"), ("word " * 3, "en"), ("x" * 200_000, None)] * 2
    assert _got(C.collocations(_docs(spark, rows))) == _phrases_brute(rows, 100)


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    """Every text is read once, in whatever portions its words are numbered."""
    rows = _corpus(3, 80)
    monkeypatch.setattr(C, "ROW_WORDS", 50)
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = _docs(spark, rows)
    assert _got(C.collocations(docs.mapInArrow(watched, docs.schema), min_count=2)) == _phrases_brute(rows, 2)
    assert seen.value == len(rows)


def test_a_task_hands_on_each_edge_once(spark, monkeypatch):
    """Grams of three words or more, summed over all rows of numbers that a task
    reads; the ends of words and pairs come from their counts and leave no task."""
    rows = _corpus(4, 150)
    monkeypatch.setattr(C, "ROW_WORDS", 50)
    made, real = spark.sparkContext.accumulator(0), C.arrow_map

    def watched(df, fn, schema, *more):
        def counting(batches):
            for batch in fn(batches):
                made.add(batch.num_rows)
                yield batch
        return real(df, counting if schema.startswith("w1 long, w2 long, w3 long") else fn, schema, *more)

    monkeypatch.setattr(C, "arrow_map", watched)
    vocabulary, whole, ends = C.phrase_graph(_docs(spark, rows).coalesce(1), "lang", "text", 3, 5, 0)
    assert 0 < made.value == whole.count() + ends.filter("size(words) > 2").count()
    # all places of frequent words end or go on somewhere
    places = sum(r["c"] for r in whole.unionByName(ends).collect())
    assert places == vocabulary.filter("c >= 3").agg(F.sum("c")).first()[0]


def _distinct_triples(n, words=12):
    """Texts over few words, whose pairs are frequent and whose triples mostly are not."""
    rng = random.Random(n)
    return [(" ".join(f"w{rng.randrange(words)}" for _ in range(100)), "en") for _ in range(n)]


def _made_by_filters(spark, rows, least):
    """Rows that the scans for the filters of three and four words hand on."""
    made, real = spark.sparkContext.accumulator(0), C.arrow_map

    def watched(df, fn, schema, *more):
        def counting(batches):
            for batch in fn(batches):
                made.add(batch.num_rows)
                yield batch
        return real(df, counting if schema.startswith(("place", "block")) else fn, schema, *more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(C, "arrow_map", watched)
        C.phrase_graph(_docs(spark, rows).coalesce(1), "lang", "text", least, 5, 0)
    return made.value


def test_filter_scans_grow_no_faster_than_the_words(spark):
    """With more texts more pairs are frequent, but what the filters' scans hand on
    grows with the words alone: counters in blocks, whatever triples there are."""
    few, many = (_made_by_filters(spark, _distinct_triples(n, 40), 60) for n in (200, 1600))
    assert 0 < many <= 8 * max(few, 2)


def test_counters_add_up_over_tasks_and_stop_at_the_least_count(spark):
    rows = [("a b c d", "en")] * 60 + [("a b c e", "en")] * 400 + [("x y z", None)] * 3
    for least in (60, 460):
        docs = _docs(spark, rows).repartition(7)
        assert _got(C.collocations(docs, min_count=least)) == _phrases_brute(rows, least)
    # counters wider than a byte
    rows = _distinct_triples(60, 5)
    assert _got(C.collocations(_docs(spark, rows).repartition(3), min_count=300)) == _phrases_brute(rows, 300)


def test_counters_of_a_filter():
    assert [C.counter_bits(n, 100) for n in (0, 10 ** 6, 10 ** 8, 5 * 10 ** 8, 10 ** 12)] == [15, 15, 21, 24, 27]
    for n in (10 ** 7, 10 ** 9):
        assert n / 2 ** C.counter_bits(n, 100) <= 50
    hashes = np.array([1 << 49, (1 << 49) - 1, (1 << 64) - 1], np.uint64)
    assert C.place(hashes, 15).tolist() == [1, 0, 2 ** 15 - 1]
    bits = np.zeros(1 << 12, np.uint8)
    bits[0] = 2
    assert C.passes(bits, hashes).tolist() == [True, False, False]


def test_summed_grams_add_up_counts():
    rows = np.array([[1, 2, 3], [9, 0, 0], [1, 2, 3]], np.uint64)
    found, c = C.summed_grams(rows, np.array([4, 5, 6]))
    assert sorted((*map(int, r), int(n)) for r, n in zip(found, c)) == [(1, 2, 3, 10), (9, 0, 0, 5)]
    assert len(C.summed_grams(rows[:0], np.empty(0, np.int64))[1]) == 0


def test_frequent_words_are_numbered():
    frequent = np.sort(np.array([7, 2 ** 64 - 5, 9], np.uint64).view(np.int64))
    words = np.array([0, 9, 8, 7, 2 ** 64 - 5, 2 ** 64 - 1], np.uint64)
    assert C.frequent_numbers(words, frequent).tolist() == [0, 3, 0, 2, 1, 0]
    assert C.pair_keys(np.array([0, 3, 0, 2, 1])).tolist() == [2 << 32 | 1]
    assert not C.frequent_numbers(words, frequent[:0]).any()


def test_summed_grams():
    rows = np.array([[1, 2, 3], [1, 2, 0], [1, 2, 3], [9, 0, 0], [1, 2, 3], [1, 2, 0]], np.uint64)
    found, c = C.summed_grams(rows)
    assert sorted((*map(int, r), int(n)) for r, n in zip(found, c)) == [(1, 2, 0, 2), (1, 2, 3, 3), (9, 0, 0, 1)]
    found, c = C.summed_grams(rows[:0])
    assert found.shape == (0, 3) and len(c) == 0


def test_paths_are_compacted(spark):
    """A passage that always runs whole becomes few rows, and every edge stays."""
    words = [f"p{i}" for i in range(200)]
    docs = _docs(spark, [(" ".join(words), "en")] * 3)
    _, whole, _ = C.phrase_graph(docs, "lang", "text", 2, 5, 0)
    _, paths, ends = C.phrase_graph(docs, "lang", "text", 2, 5, 3)
    edges = {tuple(r["words"]) for r in whole.collect()}
    rows = [r["words"] for r in paths.collect()]
    assert len(edges) == 196 and len(rows) < 140
    assert sorted(tuple(r[i:i + 5]) for r in rows for i in range(len(r) - 4)) == sorted(edges)
    counts = {len(r["words"]): 0 for r in C.gram_counts(paths, ends, 5).collect()}
    assert set(counts) == {1, 2, 3, 4, 5}


def test_score_beyond_64_bits(spark):
    a = F.lit(4_000_000_000_000).cast("decimal(18,0)")
    n = F.lit(9_000_000_000_000_000).cast("decimal(18,0)")
    row = (spark.range(1).withColumns({"a_": a, "n_": n, "l_": a, "r_": a})
           .select(F.expr("(cast(1000 as decimal(4,0)) * a_ * n_) div (l_ * r_)").alias("s")).first())
    assert row["s"] == 1000 * 4_000_000_000_000 * 9_000_000_000_000_000 // 4_000_000_000_000 ** 2


def _bits(hashes=None):
    out = np.zeros(1 << (C.BITS - 3), np.uint8)
    if hashes is None:
        return out + np.uint8(255)
    at = C.place(np.array(hashes, np.uint64))
    np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out


def _read(rows):
    return [[int(x) for x in row if x] for row in rows]


def test_grams_end_with_their_piece():
    words = np.array([5, 6, 7, 0, 8, 0, 0, 9], np.uint64)
    for filters in ({}, {2: _bits()}, {2: _bits(), 3: _bits()}):
        assert _read(C.grams(words, filters, 5)) == [[5, 6, 7], [6, 7], [7], [8], [9]]
    assert C.grams(np.empty(0, np.uint64), {2: _bits()}, 5).shape == (0, 5)
    assert _read(C.grams(words, {2: _bits([])}, 5)) == [[5], [6], [7], [8], [9]]
    assert _read(C.grams(words[:1], {2: _bits(), 3: _bits()}, 5)) == [[5]]


def test_grams_run_over_nothing_rare():
    words = np.array([11, 12, 13, 14, 15, 16], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    pairs, triples = C.gram_hashes(words, 2), C.gram_hashes(words, 3)
    assert len(pairs) == 5 and len(triples) == 4
    # all pairs but the fourth, all triples but the first
    filters = {2: _bits(np.delete(pairs, 3)), 3: _bits(triples[1:])}
    got = [len(r) for r in _read(C.grams(words, filters, 5))]
    assert got == [2, 3, 2, 1, 2, 1]
