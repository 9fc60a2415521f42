"""DuckDB SQL of the operators that SQL can state."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES_CTE = f"""
lines AS (
  SELECT doc_id, pos, line,
    translate(trim(line, {WHITE_SQL}), '{UPPER}', '{UPPER.lower()}') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM docs))
),
firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
),
flagged AS (
  SELECT l.doc_id, l.pos, l.line, coalesce(l.doc_id > f.first_doc, false) AS gone
  FROM lines l LEFT JOIN firsts f ON l.key = f.key
)"""

LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, text FROM documents), {LINES_CTE}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, regexp_extract_all(unnest(parts), '[^\\x20\\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(
        translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]') AS parts
      FROM documents))
),
grams AS (
  SELECT lang, size, array_to_string(words[p:p + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS p FROM pieces) w,
    (SELECT unnest(range(1, 6)) AS size) s
  WHERE p + size - 1 <= len(words)
),
found AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
cuts AS (
  SELECT lang, size, phrase, f AS a, k, array_to_string(parts[1:k], ' ') AS head,
    array_to_string(parts[k + 1:size], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS parts, unnest(range(1, size)) AS k FROM found WHERE size > 1)
),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, h.f AS l, t.f AS r, n.n,
    CAST((1000::HUGEINT * c.a * n.n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN found h ON h.lang = c.lang AND h.phrase = c.head
    JOIN found t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals n ON n.lang = c.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(parts[p:p + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, size, parts, m, unnest(range(1, size - m + 2)) AS p
        FROM (SELECT lang, f, size, string_split(phrase, ' ') AS parts, unnest(range(2, size)) AS m
              FROM found WHERE size > 2))
  GROUP BY 1, 2
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS positive_rank
  FROM pairs WHERE same QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (
    PARTITION BY p.anchor_id, positive_rank ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, positive_score, n.score AS negative_score,
  CAST(positive_rank AS INTEGER) AS positive_rank
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY rank <= 3
"""
