"""Independent SQL statements of registered queries of this subpackage, for DuckDB."""

from __future__ import annotations

OP11_LINE_FIRST_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS t FROM documents),
w AS (
  SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(t, chr(10)),
                lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
h AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS s
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM h),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM c, (SELECT unnest(range(0, 8)) AS k) WHERE n > 1 GROUP BY r),
l AS (
  SELECT r, line, lower(line) AS low, length(line) AS n,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS n_word_chars
  FROM (SELECT r, unnest(lines) AS line FROM w)),
judged AS (
  SELECT r, n_word_chars,
    NOT regexp_matches(right(line, 16),
      '[.!?\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{061F}\x{0964}]["'')\]\x{00BB}\x{2019}\x{201D}]*[\x20\x09-\x0D]*\z')
    OR len(regexp_extract_all(line, '[#*$%&|<>]')) > CAST(0.06 AS DOUBLE) * n
    OR (n <= 30 AND regexp_matches(low,
      '^[\x20\x09-\x0D]*(home|menu|login|log in|sign in|sign up|register|search|next|previous|back to top|contact us|about us|sitemap|share this|skip to content)([^a-z]|\z)'))
    OR regexp_matches(low,
      'all rights reserved|click here|cookie policy|enable javascript|javascript is|lorem ipsum|privacy policy|read more|subscribe to our newsletter|terms of service|terms of use|uses? cookies|[{}]')
    OR (separators > 0 AND separators * 50 >= n) AS failed
  FROM (SELECT *, len(regexp_extract_all(line,
          '(?:^|[\x20\x09-\x0D])[|/>\x{00BB}\x{203A}\x{00B7}\x{2022}\x{2192}]+(?:[\x20\x09-\x0D]|\z)')) AS separators
        FROM l)),
loss AS (
  SELECT r, count_if(failed) AS n_removed_lines,
    sum(CASE WHEN failed THEN n_word_chars ELSE 0 END) AS removed_chars
  FROM judged GROUP BY r),
b AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(coalesce(n_removed_lines, 0) AS BIGINT) AS n_removed_lines,
    CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars
  FROM w LEFT JOIN repeats USING (r) LEFT JOIN loss USING (r)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND removed_chars <= CAST(0.3 AS DOUBLE) * word_chars AS kept,
  n_lines, n_removed_lines, removed_chars
FROM v"""

OP12_FILL_IN_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce("text", '') AS t,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a,
    greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
           OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM n),
p AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle,
    substring(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""

OP13_LEXICAL_RANK = r"""
WITH fold AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
d AS (SELECT r, doc_id, terms, len(terms) AS n FROM fold WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS length FROM d),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1)))
                    AS BIGINT) AS w
  FROM tf, totals GROUP BY term, n_docs),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
m AS (SELECT r, doc_id, 10 + ((90 * n * n_docs) // length) AS m FROM d, totals),
s AS (
  SELECT q.item_id, tf.r, m.doc_id,
    CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m ON m.r = tf.r
  GROUP BY q.item_id, tf.r, m.doc_id),
k AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS "rank"
  FROM s WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM k WHERE "rank" <= 10"""
