"""SQL that DuckDB runs beside the queries of operators that SQL can express."""

HARD_NEGATIVES = r"""
WITH own AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: FLOOR(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM own a JOIN own b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) <= 5
"""

CONVERSATIONS = r"""
WITH RECURSIVE
steps AS (
  SELECT i, LIST_REDUCE(LIST_PREPEND(CAST(i AS BIGINT), RANGE(8)),
    LAMBDA c, k: CASE WHEN c % 2 = 1 THEN XOR(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM RANGE(256) AS t(i)
),
crc AS (SELECT LIST(v ORDER BY i) AS steps FROM steps),
marked AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
    XOR(LIST_REDUCE(LIST_PREPEND(4294967295, LIST_TRANSFORM(
        STRING_SPLIT(COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' '), ''),
        LAMBDA x: CAST(ASCII(x) AS BIGINT))),
      LAMBDA c, b: XOR(c >> 8, steps[(XOR(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN REGEXP_REPLACE(text, '[.!?]', '', 'g') ELSE text END AS text,
    UNNEST(RANGE(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked
),
placed AS (
  SELECT conv_id, turn, role, text,
    ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    LEFT(role, 1) AS initial, NOT REGEXP_MATCHES(text, '[^\x20\x09-\x0D]') AS is_blank
  FROM damaged
),
judged AS (
  SELECT *,
    NOT is_blank AND ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS is_duplicate,
    RIGHT(RTRIM(text, E' \t\n\v\f\r'), 1) NOT IN ('.', '!', '?') AS no_end,
    LAG(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
  FROM placed
),
counted AS (
  SELECT conv_id, COUNT(*) AS n_rows,
    CAST(COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS BIGINT) AS gaps,
    COUNT(*) FILTER (is_blank) AS blank, COUNT(*) FILTER (is_duplicate) AS duplicate,
    COUNT(*) FILTER (no_end AND NOT is_blank AND NOT is_duplicate) AS truncated,
    COUNT(*) FILTER (pair NOT IN ('su', 'ua', 'au') AND pair IS NOT NULL) AS illegal
  FROM judged GROUP BY conv_id
),
-- Rows without text that may stand before a row or at the end; states: n, s, u, a.
inserts(come, go, letters, cost, lines) AS (
  SELECT * FROM (VALUES ('n', 'u', 'I', 5, ['user:']), ('n', 'a', 'II', 10, ['user:', 'assistant:']),
    ('s', 'u', 'I', 5, ['user:']), ('s', 'a', 'II', 10, ['user:', 'assistant:']),
    ('u', 'a', 'I', 5, ['assistant:']), ('a', 'u', 'I', 5, ['user:']),
    ('n', 'n', '', 0, []), ('s', 's', '', 0, []), ('u', 'u', '', 0, []), ('a', 'a', '', 0, []))
),
moves(come, go) AS (SELECT * FROM (VALUES ('n', 's'), ('n', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u'))),
options AS (
  SELECT come, go, 'K' AS letter, go AS initial FROM moves
  UNION ALL SELECT come, go, 'R', NULL FROM moves WHERE go <> 's'
  UNION ALL SELECT come, come, 'D', NULL FROM (SELECT DISTINCT come FROM moves)
),
walk AS (
  SELECT conv_id, 0 AS n, 'n' AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM counted
  UNION ALL
  SELECT w.conv_id, j.n, o.go,
    w.cost + i.cost + CASE o.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
      + CASE WHEN o.letter <> 'D' AND j.no_end THEN 5 ELSE 0 END AS new_cost,
    w.audit || i.letters || o.letter AS new_audit,
    LIST_CONCAT(w.lines, LIST_CONCAT(i.lines, CASE o.letter
      WHEN 'K' THEN [j.role || ':' || j.text]
      WHEN 'R' THEN [CASE o.go WHEN 'u' THEN 'user:' ELSE 'assistant:' END || j.text] ELSE [] END))
  FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.n = w.n + 1
    JOIN inserts i ON i.come = w.state JOIN options o ON o.come = i.go
  WHERE (o.initial IS NULL OR o.initial = j.initial) AND (o.letter = 'D' OR NOT (j.is_blank OR j.is_duplicate))
  QUALIFY ROW_NUMBER() OVER (PARTITION BY w.conv_id, o.go ORDER BY new_cost, new_audit) = 1
),
ended AS (
  SELECT w.conv_id, w.cost + i.cost AS cost, w.audit || i.letters AS audit, LIST_CONCAT(w.lines, i.lines) AS lines
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n_rows = w.n
    JOIN inserts i ON i.come = w.state
  WHERE i.go IN ('n', 'a')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY w.conv_id ORDER BY w.cost + i.cost, w.audit || i.letters) = 1
)
SELECT e.conv_id, COALESCE(c.gaps, 0) AS gaps, COALESCE(c.blank, 0) AS blank, COALESCE(c.duplicate, 0) AS duplicate,
  COALESCE(c.truncated, 0) AS truncated, COALESCE(c.illegal, 0) AS illegal,
  CAST(COALESCE(d.cost, 0) AS BIGINT) AS cost, COALESCE(d.audit, '') AS audit,
  SHA256(COALESCE(ARRAY_TO_STRING(d.lines, E'\n'), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
  LEFT JOIN ended d ON d.conv_id IS NOT DISTINCT FROM e.conv_id
"""
