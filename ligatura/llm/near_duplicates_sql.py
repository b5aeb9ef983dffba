"""SQL of op3's result, for small tables: all pairs that share a shingle are compared."""

OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN least_of USING (doc_id) LEFT JOIN n USING (doc_id)
"""
