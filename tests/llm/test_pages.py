"""Page parsing: linear time, agreement with the given articles, odd rows."""

import re
import time
from html import unescape

import pytest
from pyspark.sql import types as T

from tablesync.llm.html_extract import blocks, default_field, extract_main_text, main_text

PAGES = "/root/testdata/sf0.01/pages.parquet"
SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("id", T.StringType()),
                       T.StructField("text", T.LongType()), T.StructField("n_chars", T.StringType())])


@pytest.mark.parametrize("unit", ["<a ", "<!--", "<div>x", "</", "<", '<a b="', "<ul>", "<li><ul><div>", "<p><i>x", "</b>",
                                  "&", "<script>", "<x y='", "<b><div><i></b>", "<title>", "<td><table>y"])
def test_one_megabyte_of_anything_is_linear(unit):
    known = default_field().weights
    start = time.process_time()
    blocks(unit * (1_000_000 // len(unit)), known)
    assert time.process_time() - start < 8


def test_many_class_names_are_linear():
    known = default_field().weights
    page = "".join(f'<div class="{chr(97 + i % 26) * (i // 26 + 1)}">x' for i in range(6000))
    start = time.process_time()
    found = blocks(page, known)
    assert time.process_time() - start < 8 and len(found) == 6000


def _article(html):
    """Plain text of the given pages' article, by its tag alone."""
    body = re.search(r"(?s)<article>(.*?)</article>", html)
    text = re.sub(r"(?s)<(aside|form|script|style|nav)\b.*?</\1>", "", body[1]) if body else ""
    parts = [" ".join(unescape(re.sub(r"</?(?:b|i|em|a|span|strong)\b[^>]*>", "", p).replace("<br>", " ")).split())
             for p in re.split(r"</?(?:p|h[1-6]|li|ul|ol|div|article|section|blockquote)\b[^>]*>", text)]
    return " ".join(p for p in parts if p)


def test_agrees_with_the_article_of_the_given_pages(spark):
    rows = [r["html"] for r in spark.read.parquet(PAGES).collect()]
    same = sum(main_text(h, default_field()) == _article(h) for h in rows)
    assert same >= 0.99 * len(rows)


def test_markup_cut_off_by_the_end():
    assert [t for t, _ in blocks("<p>one</p><p>two <a href='x")] == ["one", "two"]
    assert [t for t, _ in blocks("<p>one</p><!-- never closed <p>two</p>")] == ["one"]
    assert [t for t, _ in blocks("<p>one</p><script>var a = '<p>two</p>'")] == ["one"]
    assert [t for t, _ in blocks("<p>a < b <!-- c --> d</p><!--><p>e")] == ["a < b d", "e"]
    assert [t for t, _ in blocks("<p title=it's class='x>y'>kept</p><br/>after")] == ["kept", "after"]


def test_extract_odd_rows(spark):
    page = "<html><body><article><h1>Some title</h1><p>First words of it, all here.</p></article></body></html>"
    deep = "<div>" * 50_000 + "<article><p>Words deep down, all of them here.</p></article>"
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (2, "v", ""), (3, "w", "<a " * 50_000), (4, "x", deep),
            (5, "y", page.replace("words of it", "words of it " * 60_000))]
    pages = spark.createDataFrame([(*r, "a", 2, "b") for r in rows], SCHEMA)
    out = extract_main_text(pages)
    got = {}
    for r in out.collect():
        got.setdefault(r["page_id"], []).append((r["url"], r["text"], r["n_chars"]))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    text = "Some title First words of it, all here."
    assert got[1] == [("u", text, len(text))] * 2
    assert got[None] == [(None, "", 0)] and got[2] == [("v", "", 0)] and got[3] == [("w", "", 0)]
    assert got[5][0][2] > 600_000 and len(got[4]) == 1
    assert extract_main_text(spark.createDataFrame([], SCHEMA)).count() == 0
