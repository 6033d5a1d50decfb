"""DuckDB SQL for the operators whose results SQL can express, computed the
plain way: all pairs, all windows."""

WORDS = r"'[^\x20\x09-\x0D]+'"

#: From links(a, b) and the ids of ``table``: the smallest id reachable.
REACH = """
reach(id, other) AS (
  SELECT {id}, {id} FROM {table}
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), low AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

OP2 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), {REACH.format(id='vec_id', table='embeddings')}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM low
"""

OP9 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    {WORDS}) AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3
    THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), {REACH.format(id='doc_id', table='documents')}
SELECT id AS doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, id = component_id AS kept
FROM low LEFT JOIN n ON n.doc_id = id
"""

OP7 = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws FROM documents
), found AS (
  SELECT doc_id, p, array_to_string(list_slice(ws, p, p + 19), ' ') AS t
  FROM w, unnest(range(1, greatest(len(ws) - 18, 1))) u(p)
), later AS (
  SELECT doc_id, p FROM found QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, p) > 1
), gone AS (
  SELECT DISTINCT doc_id, q FROM later, unnest(range(p, p + 20)) u(q)
), each AS (
  SELECT doc_id, q, ws[q] AS word FROM w, unnest(range(1, len(ws) + 1)) u(q)
), kept AS (
  SELECT e.doc_id, count(*) AS n, count(g.q) AS removed, string_agg(word, ' ' ORDER BY e.q) FILTER (WHERE g.q IS NULL) AS text
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.q = e.q GROUP BY e.doc_id
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""
