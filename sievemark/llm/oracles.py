"""DuckDB SQL that gives the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op1_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

SQL["op3_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS o
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM d GROUP BY source
), w AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS most FROM s
), l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER f, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS DOUBLE) AS level
  FROM w WINDOW f AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, CASE weight WHEN 1 THEN -0.5 WHEN 2 THEN 0.0 ELSE 0.5 END::DOUBLE AS slope,
    least(CAST(most AS DOUBLE), max(level) OVER () * weight) AS target
  FROM l
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.slope, t.target,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS first
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE
    (2 * first + size < 2 * target)::BIGINT + (2 * (first + source_size) + size < 2 * target)::BIGINT
    + (2 * (first + 2 * source_size) + size < 2 * target)::BIGINT END AS copies,
    CAST(2 * first + size AS DOUBLE) / (2 * target) AS y0, CAST(2 * (first + source_size) + size AS DOUBLE) / (2 * target) AS y1,
    CAST(2 * (first + 2 * source_size) + size AS DOUBLE) / (2 * target) AS y2
  FROM c
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies,
  CASE WHEN copies > 0 THEN CASE WHEN slope = 0 THEN y0
    ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * y0) - (1 - slope)) / (2 * slope) END END AS position,
  CASE WHEN copies > 1 THEN CASE WHEN slope = 0 THEN y1
    ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * y1) - (1 - slope)) / (2 * slope) END END AS position2,
  CASE WHEN copies > 2 THEN CASE WHEN slope = 0 THEN y2
    ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * y2) - (1 - slope)) / (2 * slope) END END AS position3
FROM k
"""

SQL["op4_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN p.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""

SQL["op8_near_dup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' ') || '/' || least(len(w), 5))) AS s
  FROM d WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY 1
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT e.y, r.root FROM r JOIN e ON e.x = r.node WHERE r.root < e.y
), c AS (
  SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY 1
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN c ON c.doc_id = d.doc_id
"""

SQL["op9_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), x AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' '))) AS win
  FROM b WHERE len(w) > 0
), y AS (
  SELECT d.doc_id, s.n, unnest(range(1, len(w) - s.n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM x) s WHERE len(w) >= s.n
), z AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM y
), m AS (
  SELECT z.doc_id, z.i, z.n, x.item_id FROM z JOIN x ON x.win = z.win AND x.n = z.n
), h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY 1
), t AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM m GROUP BY 1
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(t.items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(t.items, ','), '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""
