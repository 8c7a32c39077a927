"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query reads its whole table and returns its full result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.collocations import collocations
from tablesync.llm.common import table
from tablesync.llm.decontaminate import contamination
from tablesync.llm.exact_dup import exact_groups
from tablesync.llm.fill_middle import fill_in_middle, restored
from tablesync.llm.html_extract import extract_main_text
from tablesync.llm.line_runs import dedup_lines
from tablesync.llm.near_dup import near_duplicates
from tablesync.llm.packing import pack_documents
from tablesync.llm.pii import find_pii, pii_digest
from tablesync.llm.quality import quality_scores
from tablesync.llm.token_counts import count_tokens
from tablesync.llm.toxicity import toxicity
from tablesync.llm.url_filter import judge_urls
from tablesync.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(find_pii(table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op5_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5 with the items of proximity matches, which its SQL has no column for."""
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), proximity=True)
    return rows.drop("text_key")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def registry() -> dict[str, Query]:
    """The queries; each sets the session's required options first."""
    def configured(query: Query) -> Query:
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {q.__name__: configured(q) for q in (
        op1_html_extract, op2_token_counts, op3_quality, op4_pii, op5_decontamination, op5_proximity, op6_toxicity,
        op7_packing, op8_near_duplicates, op9_exact_dedup, op10_url_filter, op11_fill_middle,
        op12_collocations, op13_line_dedup)}


OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (n, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
which AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN which USING (doc_id)
"""


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, s, s + 4), ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(node, other) AS (
  SELECT x, y FROM edge
  UNION SELECT r.node, b.y FROM reach r JOIN edge b ON b.x = r.other),
low AS (SELECT node, min(other) AS m FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN low ON low.node = d.doc_id
"""


OP11_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS w,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
d AS (
  SELECT doc_id, t, w, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, coalesce(array_to_string(w[1:x], ''), '') AS pre, coalesce(array_to_string(w[x + 1:y], ''), '') AS mid,
         coalesce(array_to_string(w[y + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k) GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM g WHERE f >= 100),
cand AS (
  SELECT lang, phrase, k, f FROM often a WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM often b WHERE b.lang = a.lang AND b.k > a.k AND 100 * b.f >= 100 * a.f
      AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' '))),
cut AS (
  SELECT lang, phrase, f, c, array_to_string(ws[1:c], ' ') AS first, array_to_string(ws[c + 1:], ' ') AS rest
  FROM (SELECT lang, phrase, f, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.f AS a, c, x.f AS l, y.f AS r, n,
         CAST((1000::HUGEINT * cut.f * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cut JOIN often x ON x.lang = cut.lang AND x.phrase = first JOIN often y ON y.lang = cut.lang AND y.phrase = rest
  JOIN total ON total.lang = cut.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


OP13_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE owner IS NULL OR owner = doc_id), ''))
         AS kept_sha256
FROM k LEFT JOIN o USING (key) GROUP BY doc_id
"""


def oracles() -> dict[str, str]:
    return {"op5_decontamination": OP5_SQL, "op8_near_duplicates": OP8_SQL, "op9_exact_dedup": OP9_SQL,
            "op11_fill_middle": OP11_SQL, "op12_collocations": OP12_SQL, "op13_line_dedup": OP13_SQL}
