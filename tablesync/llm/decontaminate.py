"""Benchmark decontamination by a positional inverted index (SQL functions only).

1. ``build_index`` tokenises every training text once and stores a posting
   (term, row, position) for each token that is a term of the benchmark, as
   Parquet segments that keep the order of the input: nothing is shuffled.  One
   more posting a row keeps its id and its number of words.
2. ``find_matches`` takes for each window of benchmark words its rarest terms
   (by the index's own counts) and turns their lists into diagonals (position
   in the text minus position in the item).  For exact phrases the lists of two
   are intersected; diagonals that survive meet the postings of all other words
   of their windows.  A proximity match is a window with ``NEAR_SHARE`` of its
   words within ``SLACK`` positions of one diagonal.  If it may lack m words, at
   least two of its m + 2 rarest are in place: lists are met in ranges of
   diagonals, and ranges with enough of them meet the other words.

Every group is keyed by row and diagonals, so no key outgrows one text; lists of
test terms and surviving rows are broadcast only below a counted bound and
joined by shuffle beyond it.

Edge cases: null or empty texts have no words; an item without words has no
window; null item ids are reported as the text ``null``; repeated items with
one id count once; repeated rows give repeated results; empty tables give an
empty result or one without hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import broadcast_if_small, lower_ascii, stage, text_key, whole_text

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SLACK = 3
NEAR_SHARE = 0.8
# the term of the posting that holds a row's id and number of words
ROW_TERM = -1


def words(text_col: str) -> Column:
    return F.regexp_extract_all(lower_ascii(whole_text(text_col)), F.lit(WORD), F.lit(0))


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Staged: item (a row number), item_id, words; items without words go."""
    rows = items.select(F.monotonically_increasing_id().alias("item"),
                        F.col(id_col).alias("item_id"), words(text_col).alias("words"))
    return stage(rows.filter(F.size("words") > 0), "decon-items")


def build_index(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(postings, terms): terms has word and term (its number)."""
    vocabulary = items.select(F.explode("words").alias("word")).distinct()
    terms = stage(vocabulary.select("word", F.monotonically_increasing_id().alias("term")), "decon-terms")
    listed = terms.unionByName(terms.sparkSession.range(1).select(
        F.lit("").alias("word"), F.lit(ROW_TERM).cast("long").alias("term")))
    # the empty word, last in its text, stands for the row: its position is the number of words
    # (rows are numbered below the explode, not after it)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       text_key(text_col).alias("text_key"), words(text_col).alias("words"))
    tokens = rows.select("row", "id", "text_key", F.posexplode(
        F.concat("words", F.array(F.lit("")))).alias("pos", "word"))
    is_row = F.col("term") == ROW_TERM
    postings = tokens.join(broadcast_if_small(listed), "word").select(
        "term", "row", "pos", F.when(is_row, F.col("id")).alias("id"),
        F.when(is_row, F.col("text_key")).alias("text_key"))
    return stage(postings, "decon-index"), terms


def windows_of(items: DataFrame, terms: DataFrame, counts: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(item terms, windows): item, q (position in the item), term; and item,
    s (first position), n (words) and rare ((count, position) of its words,
    rarest first)."""
    placed = (items.select("item", F.posexplode("words").alias("q", "word"))
              .join(broadcast_if_small(terms), "word").select("item", "q", "term"))
    starts = items.select(
        "item", F.least(F.size("words"), F.lit(window)).alias("n"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))).alias("s"))
    rarity = (placed.join(broadcast_if_small(counts), "term", "left")
              .select("item", "q", F.coalesce("c", F.lit(0)).alias("c")))
    places = starts.select("item", "s", "n", F.explode(F.sequence("s", F.expr("s + n - 1"))).alias("q"))
    rare = (places.join(rarity, ["item", "q"]).groupBy("item", "s", "n")
            .agg(F.array_sort(F.collect_list(F.struct("c", "q"))).alias("rare")))
    return placed, rare


def _phrases(tokens: DataFrame, placed: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows whose words all lie on a diagonal: row, item, start, s, n."""
    # a window with a word that no text has cannot occur
    windows = stage(windows.filter(F.col("rare")[0]["c"] > 0).select(
        "item", "s", "n", F.col("rare")[0]["q"].alias("q1"),
        F.coalesce(F.try_element_at("rare", F.lit(2))["q"], F.col("rare")[0]["q"]).alias("q2")), "decon-windows")

    # offset-adjusted lists of the rarest terms, intersected on the diagonal
    anchors = (windows.select("item", F.explode(F.array("q1", "q2")).alias("q")).distinct()
               .join(placed, ["item", "q"]))
    lists = (tokens.join(broadcast_if_small(anchors), "term")
             .select("row", "item", (F.col("pos") - F.col("q")).alias("d"), "q"))
    met = lists.groupBy("row", "item", "d").agg(F.collect_set("q").alias("qs"))
    alive = (met.join(broadcast_if_small(windows), "item")
             .filter("array_contains(qs, q1) and array_contains(qs, q2)")
             .select("row", "item", "d", "s", "n"))
    alive = stage(alive, "decon-alive")

    # the other words of those windows
    need = (alive.select("row", "item", "d", F.explode(F.sequence("s", F.expr("s + n - 1"))).alias("q"))
            .distinct().join(broadcast_if_small(placed), ["item", "q"]))
    rows = broadcast_if_small(alive.select("row").distinct())
    near = tokens.join(rows, "row", "left_semi")
    found = (need.join(near, ["row", "term"]).filter("pos = d + q")
             .groupBy("row", "item", "d").agg(F.collect_set("q").alias("exact")))
    return (alive.join(found, ["row", "item", "d"])
            .filter("size(array_intersect(sequence(s, s + n - 1), exact)) = n")
            .select("row", "item", (F.col("d") + F.col("s")).alias("start"), "s", "n"))


def _proximities(tokens: DataFrame, placed: DataFrame, windows: DataFrame, slack: int,
                 near_share: float) -> DataFrame:
    """Windows with enough words near a diagonal: row, item, start, s, n.  The
    diagonals D of a text are dealt in ranges of ``width``; range b holds
    b * width <= D - slack < (b + 1) * width, and a word near one of its D has
    a diagonal of b * width up to (b + 2) * width - 1."""
    width = 2 * slack + 1
    # of the `tried` rarest words at least `meet` are near; a word that no text has is not
    windows = (windows.withColumn("enough", F.ceil(F.col("n") * near_share).cast("int"))
               .filter("size(filter(rare, x -> x.c > 0)) >= enough")
               .withColumn("tried", F.expr("least(n, n - enough + 2)"))
               .withColumn("qs", F.expr("transform(slice(rare, 1, tried), x -> x.q)"))
               .withColumn("bits", F.expr("aggregate(qs, 0L, (a, q) -> a | shiftleft(1L, q % 64))"))
               # windows of more than 64 words share bits
               .withColumn("meet", F.expr("bit_count(bits) - (n - enough)")))
    windows = stage(windows.select("item", "s", "n", "enough", "meet", "qs", "bits"), "decon-near-windows")

    anchors = windows.select("item", F.explode("qs").alias("q")).distinct().join(placed, ["item", "q"])
    lists = (tokens.join(broadcast_if_small(anchors), "term")
             .withColumn("at", F.expr(f"cast(floor((pos - q) / {width}) as int)"))
             .select("row", "item", F.explode(F.array(F.col("at") - 1, F.col("at"))).alias("b"),
                     F.expr("shiftleft(1L, q % 64)").alias("bit")))
    least = windows.groupBy("item").agg(F.min("meet").alias("least"))
    # places 64 apart share a bit: this only lets more through
    alive = (lists.groupBy("row", "item", "b").agg(F.bit_or("bit").alias("got"))
             .join(broadcast_if_small(least), "item").filter("bit_count(got) >= least")
             .join(broadcast_if_small(windows.drop("qs")), "item").filter("bit_count(got & bits) >= meet")
             .select("row", "item", "b", "s", "n", "enough"))
    alive = stage(alive, "decon-near-alive")

    need = (alive.select("row", "item", "b", F.explode(F.sequence("s", F.expr("s + n - 1"))).alias("q"))
            .distinct().join(broadcast_if_small(placed), ["item", "q"]))
    near = tokens.join(broadcast_if_small(alive.select("row").distinct()), "row", "left_semi")
    # a bit for each D of the range that the word is near to
    every = (1 << width) - 1
    found = (broadcast_if_small(need).join(near, ["row", "term"])
             .withColumn("shift", F.expr(f"pos - q - b * {width}"))
             .filter(f"shift between 0 and {width + 2 * slack - 1}")
             .withColumn("near", F.expr(f"{every}L & shiftright(shiftleft({every}L, shift), {2 * slack})"))
             .groupBy("row", "item", "b", "q").agg(F.bit_or("near").alias("near")))
    counts = [F.sum(F.expr(f"shiftright(near, {j}) & 1")).alias(f"n{j}") for j in range(width)]
    best = F.greatest(*(F.struct(F.col(f"n{j}").alias("c"), F.lit(-abs(j - slack)).alias("mid"), F.lit(j).alias("j"))
                        for j in range(width)))
    return (alive.join(found, ["row", "item", "b"]).filter("q between s and s + n - 1")
            .groupBy("row", "item", "b", "s", "n", "enough").agg(*counts).withColumn("best", best)
            .filter("best.c >= enough")
            .select("row", "item", F.expr(f"b * {width} + {slack} + best.j + s").alias("start"), "s", "n"))


def find_matches(postings: DataFrame, terms: DataFrame, items: DataFrame, window: int = WINDOW,
                 slack: int = SLACK, near_share: float = NEAR_SHARE, proximity: bool = True) -> DataFrame:
    """Matching windows: row, item, start, n (words) and kind (phrase, or with
    ``proximity`` also proximity; a proximity match's start is where the phrase
    would begin: one for each range of diagonals, none beside a phrase match of
    the same window)."""
    tokens = postings.filter(F.col("term") != ROW_TERM).select("term", "row", "pos")
    counts = stage(tokens.groupBy("term").agg(F.count("*").alias("c")), "decon-counts")
    placed, windows = windows_of(items, terms, counts, window)
    placed, windows = stage(placed, "decon-placed"), stage(windows, "decon-rare")
    exact = _phrases(tokens, placed, windows)
    out = exact.withColumn("kind", F.lit("phrase"))
    if proximity:
        exact = stage(exact, "decon-phrases")
        same = exact.select("row", "item", "s", F.col("start").alias("begin"))
        near = _proximities(tokens, placed, windows, slack, near_share)
        near = near.join(same, (near["row"] == same["row"]) & (near["item"] == same["item"]) & (near["s"] == same["s"])
                         & F.abs(near["start"] - same["begin"]).between(0, 2 * slack), "left_anti")
        out = exact.withColumn("kind", F.lit("phrase")).unionByName(near.withColumn("kind", F.lit("proximity")))
    return out.select("row", "item", "start", "n", "kind")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, proximity: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit`` (words inside a
    phrase match), ``n_items``, ``item_ids`` (sorted as strings),
    ``contaminated`` and ``text_key`` (the row's fingerprint); with
    ``proximity`` also ``near_item_ids`` (items of proximity matches, sorted)."""
    items = item_words(items, item_id_col, item_text_col)
    postings, terms = build_index(docs, items, id_col, text_col)
    every = stage(find_matches(postings, terms, items, window, proximity=proximity), "decon-matches")
    matches = every.filter("kind = 'phrase'")
    hit = (matches.select("row", "start", "n").distinct()
           .select("row", F.explode(F.expr("sequence(start, start + n - 1)")).alias("pos")).distinct()
           .groupBy("row").agg(F.count("*").alias("n_hit")))
    named = items.select("item", F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"))
    which = (matches.select("row", "item").distinct().join(broadcast_if_small(named), "item")
             .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    rows = postings.filter(F.col("term") == ROW_TERM).select("row", "id", "text_key", "pos")
    result = rows.join(hit.join(which, "row"), "row", "left")
    near = []
    if proximity:
        by_row = (every.filter("kind = 'proximity'").select("row", "item").distinct()
                  .join(broadcast_if_small(named), "item")
                  .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("near_item_ids")))
        result = result.join(by_row, "row", "left")
        near = [F.coalesce("near_item_ids", F.array().cast("array<string>")).alias("near_item_ids")]
    return result.select(
        F.col("id").alias(id_col), F.col("pos").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"), "text_key", *near)
