"""Main text of web pages: a linear-chain conditional random field over blocks.

The page is parsed into leaf blocks (text between block-level tags).  A block's
features are its ancestors' tags, the words in their class, id and role
attributes, its length, links, punctuation and digits.  The field has one
weight a feature, transitions between main and other blocks, and start and end
weights; it is trained by gradient ascent of the conditional likelihood
(forward-backward over all training pages at once) on labelled pages made from
layout templates (``html_pages``), and decoded by Viterbi.  Training takes
seconds where the job is planned; the weights are a small broadcast.  One scan,
one Arrow pass, no shuffle; pages are parsed whole.

Text inside a block is decoded and its white space becomes one space; main
blocks are joined by one space.  Scripts, styles, templates and the head hold
no blocks; a head without an end tag ends where HTML ends it, at a tag or text that
it cannot hold.  A tag, comment, script or style that the end of the page cuts
off is markup to the end, as in HTML.  Parsing takes time in proportion to the
page, whatever bytes it holds.

Edge cases: a null or empty page, or one without main blocks, has an empty
text; a null id or url stays null; repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_map, balanced
from tablesync.llm.html_pages import Part, training_pages

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q s
samp small span strike strong sub sup time tt u var wbr img""".split())
SILENT = frozenset("script style template noscript head title svg iframe object textarea select option button".split())
# any other opening tag, or text, ends an open head whose end tag was left out
IN_HEAD = frozenset("html head base basefont bgsound link meta title script style noscript noframes template".split())
# these hold any tag but body, in the head too
HOLDERS = frozenset("noscript noframes template".split())
# an opening tag of the key ends an open element of the value, up to a container
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)),
          "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table"))}
TRAIN_PAGES = 1000
EPOCHS, RATE, PENALTY = 150, 0.5, 1e-4
NAME = re.compile(r"[a-z]+")
# a page's markup, each in one pass without going back: an unclosed one ends the page
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*+))?""")
OPENING = re.compile(r"""<([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|["'])*+)>""")
ENDING = re.compile(r"</([A-Za-z][^\s/>]*+)[^>]*+>")
COMMENT_END = re.compile(r"--!?>")
# the content of these is text up to their own end tag
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "title", "textarea")}


class Blocks:
    """Leaf blocks of a page: (text, features).  Every step costs the same
    however deep the page is nested: open elements are known by the places of
    each name, names of classes by their counts.  ``known`` limits the features
    to a model's own."""

    def __init__(self, known: Collection[str] | None = None) -> None:
        self.known = known
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.places: dict[str, list[int]] = {}      # of the open elements, by tag
        self.outer: list[int] = []                  # of those that are not inline
        self.names: dict[str, int] = {}             # how many open elements have a name
        self.silent = 0
        self.text: list[str] = []
        self.linked = 0
        self.links = 0
        self.found: list[tuple[str, list[str]]] = []

    def _end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append((text, self._features(text)))
        self.text, self.linked = [], 0

    def _features(self, text: str) -> list[str]:
        own = set(self.names)
        own.add("parent " + (self.open[self.outer[-1]][0] if self.outer else "none"))
        words = text.count(" ") + 1
        own.add("words " + ("1" if words == 1 else "2" if words < 5 else "5" if words < 10
                            else "10" if words < 25 else "25"))
        share = self.linked / len(text)
        own.add("links " + ("none" if share == 0 else "some" if share < 0.5 else "most"))
        own.add("stop" if text[-1] in ".!?:;\"'" else "no stop")
        if "," in text:
            own.add("comma")
        if "©" in text:
            own.add("copyright")
        if any(c.isdigit() for c in text):
            own.add("digit")
        return sorted(own)

    def _last(self, tag: str) -> int:
        """The place of the innermost open element of a tag, or -1."""
        at = self.places.get(tag)
        return at[-1] if at else -1

    def _end_head(self, tag: str) -> None:
        if at := self.places.get("head"):
            if tag == "body" or max(map(self._last, HOLDERS)) < at[0]:
                self._pop(at[0])

    def start(self, tag: str, attrs: list[tuple[str, str]]) -> None:
        if self.silent and tag not in IN_HEAD:
            self._end_head(tag)
        if tag not in INLINE:
            self._end_block()
            if tag == "p" or tag not in VOID:
                self._close("p", ("button", "td", "th", "li", "article", "section", "div", "body", "main", "aside",
                                  "blockquote", "footer", "header", "nav", "form", "table"))
            if tag in CLOSES:
                self._close(*CLOSES[tag])
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        names = {"in " + tag}
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                names |= {"name " + w for w in NAME.findall(v.lower())}
            elif k == "hidden" or (k == "style" and v and "none" in v.lower()):
                names.add("hidden")
        if self.known is not None:
            names = {n for n in names if n in self.known}
        for n in names:
            self.names[n] = self.names.get(n, 0) + 1
        self.places.setdefault(tag, []).append(len(self.open))
        if tag not in INLINE:
            self.outer.append(len(self.open))
        self.open.append((tag, tuple(names)))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def _pop(self, i: int) -> None:
        while len(self.open) > i:
            tag, names = self.open.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.outer.pop()
            for n in names:
                self.names[n] -= 1
                if not self.names[n]:
                    del self.names[n]
            self.silent -= tag in SILENT
            self.links -= tag == "a"

    def _close(self, tag: str, within: tuple[str, ...]) -> None:
        i = self._last(tag)
        if i >= 0 and i > max(self._last(w) for w in within if w != tag):
            self._pop(i)

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_block()
        i = self._last(tag)
        # an inline end tag reaches no further than the innermost other element
        if i >= 0 and (tag not in INLINE or not self.outer or i > self.outer[-1]):
            self._pop(i)

    def data(self, data: str) -> None:
        data = unescape(data) if "&" in data else data
        if self.silent and self.open[-1][0] == "head" and data.strip():
            self._end_head("")
        if not self.silent:
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())

    def _attributes(self, raw: str) -> tuple[list[tuple[str, str]], bool]:
        """Names and values, and whether a slash ends the tag."""
        out, end = [], 0
        for m in ATTRIBUTE.finditer(raw):
            value = m[2] or ""
            out.append((m[1].lower(), unescape(value[1:-1] if value[:1] in ("'", '"') else value)))
            end = m.end()
        return out, "/" in raw[end:]

    def feed(self, html: str) -> None:
        at = 0
        while (i := html.find("<", at)) >= 0:
            if i > at:
                self.data(html[at:i])
            c = html[i + 1:i + 2]
            if c.isascii() and c.isalpha():
                m = OPENING.match(html, i)
                if m is None:
                    break
                tag = m[1].lower()
                attrs, closed = self._attributes(m[2]) if m[2] else ([], False)
                self.start(tag, attrs)
                at = m.end()
                if closed:
                    self.end(tag)
                elif tag in RAW:
                    m = RAW[tag].search(html, at)
                    if m is None:
                        break
                    at = m.start()
            elif c == "/":
                m = ENDING.match(html, i)
                if m:
                    self.end(m[1].lower())
                    at = m.end()
                else:
                    at = html.find(">", i) + 1
            elif c in ("!", "?"):
                if html.startswith("<!--", i):
                    m = COMMENT_END.search(html, i + 2)
                    at = m.end() if m else 0
                else:
                    at = html.find(">", i) + 1
            elif c:
                self.data("<")
                at = i + 1
            else:
                break
            if not at:
                break
        else:
            self.data(html[at:])
        self._end_block()


def blocks(html: str, known: Collection[str] | None = None) -> list[tuple[str, list[str]]]:
    parser = Blocks(known)
    parser.feed(html)
    return parser.found


def _labelled(parts: list[Part]) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a training page's blocks: the page is parsed
    whole, a block is main if the part its text came from is."""
    mark = {True: "\ue000", False: "\ue001"}
    html = "".join(re.sub(r">([^<]*[^<\s][^<]*)", lambda m, k=main: ">" + mark[k] + m[1], p) for p, main in parts)
    found, labels = [], []
    for text, names in blocks(html):
        labels.append(int(mark[True] in text))
        found.append((text.replace(mark[True], "").replace(mark[False], ""), names))
    return [names for _, names in found], labels


class Field:
    """Weights by feature name, ``step[a, b]`` from label a to b, start, end."""

    def __init__(self, weights: dict[str, float], start: np.ndarray, step: np.ndarray, end: np.ndarray):
        self.weights, self.start, self.step, self.end = weights, start.tolist(), step.tolist(), end.tolist()

    def decode(self, pages_blocks: list[list[str]]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        if not pages_blocks:
            return []
        get = self.weights.get
        gain = [sum(get(f, 0.0) for f in names) for names in pages_blocks]
        (s00, s01), (s10, s11) = self.step
        a, b = self.start[0], self.start[1] + gain[0]
        back = []
        for g in gain[1:]:
            to0 = (0, a + s00) if a + s00 >= b + s10 else (1, b + s10)
            to1 = (0, a + s01) if a + s01 >= b + s11 else (1, b + s11)
            back.append((to0[0], to1[0]))
            a, b = to0[1], to1[1] + g
        label = int(b + self.end[1] > a + self.end[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def train(pages: list[list[Part]]) -> Field:
    """Penalised maximum likelihood by gradient ascent over padded pages."""
    data = [d for d in map(_labelled, pages) if d[1]]
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in data for r in rows for f in r}))}
    n, t = len(data), max(len(y) for _, y in data)
    length = np.array([len(y) for _, y in data])
    y = np.zeros((n, t), np.int64)
    cols, cells = [], []
    for i, (rows, labels) in enumerate(data):
        y[i, :len(labels)] = labels
        for j, r in enumerate(rows):
            cols += [names[f] for f in r]
            cells += [i * t + j] * len(r)
    cols, cells = np.array(cols), np.array(cells)
    mask = np.arange(t)[None, :] < length[:, None]
    w, start, step, end = np.zeros(len(names)), np.zeros(2), np.zeros((2, 2)), np.zeros(2)
    past = [np.full_like(p, 1e-8) for p in (w, start, step, end)]
    rows = np.arange(n)
    last = length - 1
    for _ in range(EPOCHS):
        gain = np.zeros((n, t, 2))
        gain[:, :, 1] = np.bincount(cells, w[cols], n * t).reshape(n, t)
        fwd, bwd = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        fwd[:, 0] = start + gain[:, 0]
        for j in range(1, t):
            fwd[:, j] = np.logaddexp.reduce(fwd[:, j - 1, :, None] + step, axis=1) + gain[:, j]
        bwd[rows, last] = end
        for j in range(t - 2, -1, -1):
            own = np.logaddexp.reduce(step + (gain[:, j + 1] + bwd[:, j + 1])[:, None, :], axis=2)
            bwd[:, j] = np.where((j < last)[:, None], own, np.where((j == last)[:, None], end, 0))
        total = np.logaddexp.reduce(fwd[rows, last] + end, axis=1)
        p = np.exp(fwd + bwd - total[:, None, None]) * mask[:, :, None]
        pair = np.exp(fwd[:, :-1, :, None] + step + (gain[:, 1:] + bwd[:, 1:])[:, :, None, :]
                      - total[:, None, None, None]) * mask[:, 1:, None, None]
        seen_pair = np.zeros((2, 2))
        np.add.at(seen_pair, (y[:, :-1][mask[:, 1:]], y[:, 1:][mask[:, 1:]]), 1)
        grads = [np.bincount(cols, (y - p[:, :, 1]).reshape(-1)[cells], len(names)) / n - PENALTY * w,
                 (np.eye(2)[y[:, 0]] - p[:, 0]).mean(axis=0),
                 (seen_pair - pair.sum(axis=(0, 1))) / n,
                 (np.eye(2)[y[rows, last]] - p[rows, last]).mean(axis=0)]
        for value, grad, h in zip((w, start, step, end), grads, past):
            h += grad * grad
            value += RATE * grad / np.sqrt(h)
    return Field({f: float(w[i]) for f, i in names.items()}, start, step, end)


@cache
def default_field() -> Field:
    return train(training_pages(TRAIN_PAGES))


def main_text(html: str, field: Field) -> str:
    found = blocks(html, field.weights)
    labels = field.decode([names for _, names in found])
    return " ".join(text for (text, _), y in zip(found, labels) if y)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html", field: Field | None = None) -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` and ``n_chars``."""
    shared = pages.sparkSession.sparkContext.broadcast(field or default_field())
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    types = {f.name: f.dataType.simpleString() for f in slim.schema.fields}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part, htmls in balanced(batches, "html"):
            texts = [main_text(h, model) for h in htmls]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], ["id", "url", "text", "n_chars"])

    out = arrow_map(slim, extract, f"id {types['id']}, url {types['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
