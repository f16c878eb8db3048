"""SQL for the queries that SQL can express."""

from __future__ import annotations

# Words of all operators: runs without space and the controls 0x09 to 0x0D.
_WORD = r"[^\x20\x09-\x0D]+"

SQL = {
    "op4_target_weights": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         source_size * 3 AS cap
  FROM s
), c AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER prefix, 0))
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER prefix, 0) AS DOUBLE) AS share
  FROM w
  WINDOW prefix AS (ORDER BY cap / CAST(weight AS DOUBLE), source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), max(share) OVER () * weight) AS target FROM c
), r AS (
  SELECT source AS of_source, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM t
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0
      < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.of_source
""",
    "op7_content_defined_line_chunks": """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, CASE WHEN text IS NULL OR text = '' THEN [] ELSE string_split(text, chr(10)) END AS lines
  FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d
), h AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l
), b AS (
  SELECT *, (coalesce(lag(h) OVER doc, 0) * 31 + h) % 4294967296 % 4 = 0 AS ends FROM h
  WINDOW doc AS (PARTITION BY r ORDER BY i)
), c AS (
  SELECT *, coalesce(sum(CAST(ends AS INTEGER)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM b
), g AS (
  SELECT r, c, any_value(doc_id) AS doc_id, min(i) AS start, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS part
  FROM c GROUP BY r, c HAVING count(*) > 1
), e AS (
  SELECT r, c FROM (SELECT *, row_number() OVER (PARTITION BY part, n ORDER BY doc_id NULLS FIRST, start) AS k FROM g) WHERE k > 1
), k AS (
  SELECT c.r, c.i, c.line, e.r IS NOT NULL AS gone FROM c LEFT JOIN e ON c.r = e.r AND c.c = e.c
)
SELECT d.doc_id, CAST(len(d.lines) AS BIGINT) AS n_lines, count(*) FILTER (k.gone) AS n_removed,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (NOT k.gone), '')) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r GROUP BY d.r, d.doc_id, d.lines
""",
    "op8_level_wise_doubling": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), w AS (
  SELECT r, doc_id, unnest(range(1, len(words) - 18)) AS start, words FROM d WHERE len(words) >= 20
), h AS (
  SELECT r, doc_id, start, array_to_string(words[start:start + 19], ' ') AS win FROM w
), e AS (
  SELECT r, start FROM (SELECT *, min((coalesce(doc_id, -9223372036854775808), start)) OVER (PARTITION BY win) AS first FROM h)
  WHERE (coalesce(doc_id, -9223372036854775808), start) > first
), g AS (
  SELECT DISTINCT r, unnest(range(start, start + 20)) AS i FROM e
), k AS (
  SELECT d.r, d.doc_id, d.words, list(g.i) FILTER (g.i IS NOT NULL) AS gone
  FROM d LEFT JOIN g ON d.r = g.r GROUP BY d.r, d.doc_id, d.words
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(
         [words[i] FOR i IN range(1, len(words) + 1) IF NOT list_contains(coalesce(gone, []), i)], ' '), '')) AS kept_sha256
FROM k
""",
    "op10_streaming_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op11_external_stream_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM d
), p AS (
  SELECT lang, k, unnest([words[i:i + k - 1] for i in range(1, len(words) - k + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM p GROUP BY ALL HAVING count(*) >= 100
), n AS (
  SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang
), covered AS (
  SELECT lang, phrase[1:k - 1] AS phrase, a FROM f WHERE k > 2
  UNION SELECT lang, phrase[2:k] AS phrase, a FROM f WHERE k > 2
), c AS (
  SELECT * FROM f WHERE k > 1 AND (lang, phrase, a) NOT IN (SELECT (lang, phrase, a) FROM covered)
), s AS (
  SELECT c.lang, c.phrase, c.a, h.a AS l, t.a AS r, n.n,
         (1000::HUGEINT * c.a * n.n) // (h.a::HUGEINT * t.a) AS score, cut
  FROM c, (SELECT unnest([1, 2, 3, 4]) AS cut), f h, f t, n
  WHERE cut < c.k AND h.lang = c.lang AND h.phrase = c.phrase[1:cut]
    AND t.lang = c.lang AND t.phrase = c.phrase[cut + 1:c.k] AND n.lang = c.lang
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM s
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
         array_to_string(phrase, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
  FROM best WHERE nth = 1
)
SELECT * FROM ranked WHERE rank <= 2000
""",
}
