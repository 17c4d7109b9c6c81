"""DuckDB SQL of the training-data queries that SQL can express."""

MERKLE_SQL = """
WITH RECURSIVE parts AS (
  SELECT doc_id, lang, n_chars, row_number() OVER () AS rid,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS crc,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS before,
         coalesce(strlen(text) || ':' || text, '-') AS after
  FROM documents),
leaves AS (
  SELECT rid, doc_id, coalesce('1' || lang, '0') AS g,
         sha256(before || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || after) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(before || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || after) END AS tampered
  FROM parts),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
tree(g, lvl, idx, h) AS (
  SELECT g, 0, idx, leaf FROM placed
  UNION ALL
  SELECT g, max(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS m FROM tree) WHERE m > 1 GROUP BY g, idx // 2),
subroots AS (SELECT g, arg_max(h, lvl) AS subroot, max(lvl) AS depth, row_number() OVER (ORDER BY g) - 1 AS idx FROM tree GROUP BY g),
top(lvl, idx, h) AS (
  SELECT 0, idx, subroot FROM subroots
  UNION ALL
  SELECT max(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS m FROM top) WHERE m > 1 GROUP BY idx // 2),
ends AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS depth FROM top),
steps AS (
  SELECT p.rid, l.lvl, CASE WHEN s.h IS NULL THEN 'N' WHEN (p.idx >> l.lvl) % 2 = 1 THEN 'L' || s.h ELSE 'R' || s.h END AS step
  FROM placed p JOIN subroots r USING (g) JOIN (SELECT unnest(range(64)) AS lvl) l ON l.lvl < r.depth
  LEFT JOIN tree s ON s.g = p.g AND s.lvl = l.lvl AND s.idx = xor(p.idx >> l.lvl, 1)
  UNION ALL
  SELECT p.rid, 64 + l.lvl, CASE WHEN s.h IS NULL THEN 'N' WHEN (r.idx >> l.lvl) % 2 = 1 THEN 'L' || s.h ELSE 'R' || s.h END
  FROM placed p JOIN subroots r USING (g) JOIN ends e ON true JOIN (SELECT unnest(range(64)) AS lvl) l ON l.lvl < e.depth
  LEFT JOIN top s ON s.lvl = l.lvl AND s.idx = xor(r.idx >> l.lvl, 1)),
ways AS (SELECT rid, list(step ORDER BY lvl) AS way FROM steps GROUP BY rid),
folds AS (
  SELECT p.*, r.subroot, e.root, coalesce(w.way, []) AS way,
         list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(w.way, [])),
           lambda h, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || h WHEN 'R' THEN h || s[2:] ELSE h END)) AS folded_root
  FROM placed p JOIN subroots r USING (g) JOIN ends e ON true LEFT JOIN ways w USING (rid))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda s: s[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folds
"""

NEGATIVES_SQL = """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM whole a JOIN whole r ON a.id % 50 = 0 AND a.id <> r.id),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
inside AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM inside WHERE rank <= 3
"""

JACCARD_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM cut),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * b.n >= 90 * a.n AND 100 * a.n >= 90 * b.n
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (min(a.n) + min(b.n) - count(*))),
reach(x, y) AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(low.y, s.doc_id)) AS component_id
FROM sets s LEFT JOIN low ON low.x = s.doc_id
"""
