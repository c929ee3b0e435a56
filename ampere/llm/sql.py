"""DuckDB SQL of the queries that SQL can express, written from the operators' definitions."""

from __future__ import annotations

# Fixed values, stated again so that a slip in the operator's lists shows.
_MENU = ("about|account|blog|cart|contact|faq|help|home|login|logout|menu|news|next|previous|"
         "products|register|search|share|sitemap|skip|top|us")
_NOTICE = (r"all rights reserved|cookie policy|copyright \(c\)|enable javascript|licensed under|"
           r"privacy policy|subscribe to our newsletter|terms of service|terms of use|"
           r"this site uses cookies|use of cookies")

QUALITY_LINES = rf"""
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs),
judged AS (SELECT rid, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM lines),
good AS (
  SELECT rid, line, n, n > 0 AND (
      len(regexp_extract_all(line, '[!?]{{2,}}')) >= 3
   OR len(regexp_extract_all(line, '[#*$%&|<>]')) * 10 > length(line)
   OR (n < 8 AND NOT regexp_matches(line, '[.!?:;…。！？"''”’»)\]][\x20\x09-\x0D]*$'))
   OR (len(list_filter(string_split_regex(line, '[\x20\x09]'),
                       lambda x: x IN ('|', '›', '»', '·', '>', '/', '•'))) * 3 >= n)
   OR regexp_matches(line, '(?i)^[\x20\x09-\x0D]*(?:{_MENU})(?:[\x20\x09|›»·>/•]+(?:{_MENU})){{0,11}}[\x20\x09-\x0D]*$')
   OR regexp_matches(line, '(?i)(?:{_NOTICE})')) AS fails
  FROM judged),
by_line AS (
  SELECT rid, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
         coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (fails), 0) AS lost_chars
  FROM good GROUP BY rid),
grams AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (
  SELECT rid, unnest(list_value(i, i + 1, i + 2)) AS i
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i) AS n_repeat_words FROM twice GROUP BY rid)
"""



def _clusters(k: int = 40, dims: int = 64, rounds: int = 5, seed: int = 2, scale: int = 256) -> str:
    """Plain integer k-means: every vector against every centroid, round after round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
far{r} AS MATERIALIZED (SELECT rid, c, sum((a - b) * (a - b))::BIGINT AS d FROM p JOIN q{r} USING (j) GROUP BY rid, c),
near{r} AS MATERIALIZED (
  SELECT rid, c, d FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS o FROM far{r}) WHERE o = 1)""")
        if r < rounds:
            steps.append(f"""
q{r + 1} AS MATERIALIZED (
  SELECT c, j, coalesce((s - ((s % n) + n) % n) // n, b) AS b
  FROM q{r} LEFT JOIN (SELECT c, j, sum(a)::BIGINT AS s, count(*) AS n FROM p JOIN near{r} USING (rid) GROUP BY c, j) USING (c, j))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e::DOUBLE))) = 0),
p AS MATERIALIZED (SELECT rid, unnest(range(1, {dims + 1})) AS j, unnest(x) AS a FROM v),
first AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR), x) - 1 AS c, x FROM v),
q0 AS MATERIALIZED (SELECT c, unnest(range(1, {dims + 1})) AS j, unnest(x) AS b FROM first WHERE c < {k}),{",".join(steps)},
digest AS (SELECT c, sha256(string_agg(b::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM q{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM near{rounds} JOIN v USING (rid) JOIN digest USING (c)"""


# crc32 bit by bit: each byte is mixed in by the first of its eight steps.
SPELLING = """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS m FROM runs GROUP BY doc_id, run),
steps AS (
  SELECT run, m, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda ch:
      CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]
           ELSE [195::BIGINT, 0, 0, 0, 0, 0, 0, 0, unicode(ch) - 64, 0, 0, 0, 0, 0, 0, 0] END)) AS s
  FROM counted),
hashed AS (
  SELECT run, m, xor(list_reduce(list_prepend(4294967295::BIGINT, s), lambda a, b:
      xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) AS h
  FROM steps),
cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(m)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM places),
pairs AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN shorter b ON a.word = b.d
  UNION SELECT b.word, a.word, a.n FROM words a JOIN shorter b ON a.word = b.d),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS o FROM pairs),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.o = 1),
walk(word, up) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT k.word, f.form FROM walk k JOIN formed f ON f.word = k.up WHERE f.form IS NOT NULL),
ends AS (SELECT k.word, k.up FROM walk k JOIN formed f ON f.word = k.up WHERE f.form IS NULL)
SELECT word, form, up AS root, n, n_near, form_n FROM formed JOIN ends USING (word)"""

ORACLE: dict[str, str] = {
    "op11_spelling_variants": SPELLING,
    "op12_centroid_clusters": _clusters(),
    "op8_line_quality_rules": rf"""
WITH {QUALITY_LINES},
figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         n_dup_lines::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         lost_chars
  FROM docs JOIN words USING (rid) JOIN by_line USING (rid) LEFT JOIN rep USING (rid)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (word_chars = 0 OR lost_chars::DOUBLE / word_chars <= 0.3) AS kept
FROM base""",
}
