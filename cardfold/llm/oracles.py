"""DuckDB SQL for the corpus queries that SQL can express."""

ORACLES: dict[str, str] = {}

#: Five-word shingle sets, links and the components they span.
ORACLES["op6_minhash_neardup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)
), e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS low FROM n
  UNION
  SELECT e.y, r.low FROM reach r JOIN e ON e.x = r.doc_id WHERE r.low < e.y
), c AS (SELECT doc_id, min(low) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

#: Windows of 13 words, each owned by the items that hold it.
ORACLES["op5_benchmark_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), bg AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS size,
    unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2), lambda i: array_to_string(ws[i:i + least(13, len(ws)) - 1], ' '))) AS g
  FROM bw WHERE len(ws) > 0
), sizes AS (SELECT DISTINCT size FROM bg),
dg AS (
  SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS i,
    unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS g
  FROM dw, sizes WHERE len(ws) >= size
), hits AS (SELECT doc_id, i, dg.size, item_id FROM dg JOIN bg ON dg.g = bg.g AND dg.size = bg.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: Host and path, then the longest rule whose host is the url's or a parent of it.
ORACLES["op7_url_filter"] = r"""
WITH r(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), m AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN r ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""

#: Each window of 13 words with the smallest document that has it.
ORACLES["op1_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i,
    unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i+12], ' '))) AS g
  FROM w WHERE len(ws) >= 13
), low AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN low USING (g) WHERE low < doc_id),
out AS (SELECT doc_id, list(p) AS ps, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM w LEFT JOIN out USING (doc_id)
"""

#: Integer vectors, anchors against all rows, five positives, five negatives of each.
ORACLES["op13_hard_negatives"] = r"""
WITH v AS (
  SELECT DISTINCT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS alabel, r.vec_id AS rid, r.label AS rlabel,
         list_dot_product(a.q, r.q)::BIGINT AS s
  FROM a JOIN v r ON true
), pos AS (
  SELECT anchor_id, rid AS positive_id, s AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, rid) AS k
    FROM scored WHERE rlabel = alabel AND rid <> anchor_id) WHERE k <= 5
), neg AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, c.rid AS negative_id, c.s AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY c.s DESC, c.rid) AS k
  FROM pos p JOIN scored c ON c.anchor_id = p.anchor_id AND c.rlabel <> c.alabel
   AND 80 * p.positive_score <= 100 * c.s AND 100 * c.s <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE k <= 5
"""
