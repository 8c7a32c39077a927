"""Fill-in-middle transformation over the units (lines) of a document.

Two cut ranks drawn from the document's id part its units into prefix, middle
and suffix, which are then written in prefix-suffix-middle or
suffix-prefix-middle order between sentinels.  The ranks count units, the cuts
need code points: ``UnitList``, an indexable skip list, has express lanes whose
links carry both widths, and descending by the accumulated unit widths adds up
the code points on the way.  One scan and one Arrow pass; no shuffle.

Edge cases: a null or empty text has no unit and is plain; a text that holds a
sentinel is plain; a null id draws its ranks from the seed alone; ties of the
ranks give an empty middle; repeated rows give repeated results; a very long
text is a longer list; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_map, balanced

SENTINELS = ("<P>", "<S>", "<M>")
STRIDE = 16


class UnitList:
    """Indexable skip list: a link of lane k leads over ``STRIDE ** k`` units
    (the last one over what is left) and carries how many units and how many
    code points it passes.  Towers have fixed heights, so a search takes at
    most ``STRIDE`` steps a lane."""

    def __init__(self, widths: list[int]):
        units = np.ones(len(widths), np.int64)
        points = np.asarray(widths, np.int64)
        self.lanes = [(units.tolist(), points.tolist())]
        while len(units) > STRIDE:
            starts = np.arange(0, len(units), STRIDE)
            units, points = np.add.reduceat(units, starts), np.add.reduceat(points, starts)
            self.lanes.append((units.tolist(), points.tolist()))

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        link = passed = total = 0
        for units, points in reversed(self.lanes):
            link *= STRIDE
            while link < len(units) and passed + units[link] <= rank:
                passed += units[link]
                total += points[link]
                link += 1
        return total


def line_widths(text: str) -> list[int]:
    """Code points of each line with its line feed; what follows the last line
    feed is a line if not empty."""
    parts = text.split("\n")
    widths = [len(p) + 1 for p in parts[:-1]]
    return widths + [len(parts[-1])] if parts[-1] else widths


def draws(doc_id: object, seed: int) -> list[int]:
    """Four 32-bit numbers that an id has drawn."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transform(text: str, doc_id: object, seed: int, fim_percent: int, spm_percent: int) -> tuple:
    """(units, form, prefix code points, middle code points, output)."""
    widths = line_widths(text)
    n = len(widths)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= fim_percent or any(s in text for s in SENTINELS):
        return n, "plain", None, None, text
    units = UnitList(widths)
    first, second = sorted((units.points_before(h1 % (n + 1)), units.points_before(h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = SENTINELS
    if h4 % 100 < spm_percent:
        return n, "spm", first, second - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", first, second - first, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
                   fim_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Per row: id, ``n`` units, ``form`` (plain, psm, spm), ``prefix_chars``,
    ``middle_chars`` and ``output``.  ``fim_percent`` of the documents are
    transformed, ``spm_percent`` of those suffix first."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in balanced(batches, "text"):
            rows = [transform(t, i, seed, fim_percent, spm_percent)
                    for i, t in zip(part.column("id").to_pylist(), texts)]
            n, form, prefix, middle, output = map(list, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    out = arrow_map(slim, work, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, "
                                "output string")
    return out.withColumnRenamed("id", id_col)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text again, from the output and its form alone.  No sentinel can
    arise across a border, since only sentinels hold both ends of one."""
    p, s, m = SENTINELS
    out = F.col(output)

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(out, len(first) + 1, F.length(out))
        i = F.locate(second, out)
        j = F.locate(m, out)
        head = F.substring(body, F.lit(1), i - len(first) - 1)
        tail = F.substring(out, i + len(second), j - i - len(second))
        return head, tail, F.substring(out, j + len(m), F.length(out))

    prefix, suffix, middle = parts(p, s)
    late, early, between = parts(s, p)
    return (F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
            .when(F.col(form) == "spm", F.concat(early, between, late)).otherwise(out))
