"""DuckDB SQL of the queries that SQL can express."""

ORACLES = {
    "op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, pos, line, lower_key AS key
  FROM (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
  ), LATERAL (
    SELECT translate(
      regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
  )
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.*, (s.key IS NOT NULL AND l.doc_id <> s.keeper) AS dropped FROM lines l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), sets AS (SELECT doc_id, list(s ORDER BY s) AS s FROM shingles GROUP BY doc_id)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, min(r.v))::BIGINT AS component_id,
       least(d.doc_id, min(c.doc_id))::BIGINT AS class_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.u = d.doc_id
LEFT JOIN sets e ON e.doc_id = d.doc_id LEFT JOIN sets c ON c.s = e.s GROUP BY d.doc_id
""",
    "op11_minhash_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), sets AS (SELECT doc_id, list(s ORDER BY s) AS s FROM shingles GROUP BY doc_id)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, min(r.v))::BIGINT AS component_id,
       least(d.doc_id, min(c.doc_id))::BIGINT AS class_id,
       d.doc_id = least(d.doc_id, min(r.v)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.u = d.doc_id
LEFT JOIN sets e ON e.doc_id = d.doc_id LEFT JOIN sets c ON c.s = e.s GROUP BY d.doc_id
""",
    "op2_topk_search": r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scores
)
SELECT * FROM ranked WHERE rank <= 10
""",
    "op13_hard_negatives": """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole a JOIN whole c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scores WHERE same
  ) WHERE place <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT * FROM ranked WHERE rank <= 5
""",
}
