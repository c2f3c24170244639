"""DuckDB SQL of the queries that SQL can express on whole tables."""

_OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
cand AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM pos, lens WHERE i + m - 1 <= len(w)),
occ AS (SELECT c.doc_id, c.i, c.m, win.item_id FROM cand c JOIN win USING (g, m)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP9 = r"""
WITH s AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, sha256(coalesce(CAST(doc_id AS VARCHAR), 'null ' || sha256(coalesce(text, '')))) AS u FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s GROUP BY source),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM src),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(source_size * 2) OVER f, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level, (source_size * 2)::DOUBLE / weight AS ratio
      FROM w WINDOW f AS (ORDER BY (source_size * 2)::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE rank % 3 WHEN 0 THEN -0.8::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.8::DOUBLE END AS slope, CASE WHEN ratio <= level THEN source_size * 2.0::DOUBLE ELSE (SELECT max(level) FROM l WHERE ratio > level) * weight END AS target FROM l),
o AS (SELECT s.*, source_size, target, slope, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY u, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, off + pass * source_size AS b, least(size, CAST(floor(target) AS BIGINT) - (off + pass * source_size)) AS n FROM o, (VALUES (0), (1)) v(pass)),
q AS (SELECT *, n > 0 AS used, CASE WHEN slope = 0 THEN b / target ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * least(1.0::DOUBLE, b / target)) - (1 - slope)) / (2 * slope) END AS pos FROM p)
SELECT doc_id, size, source_size, target, CAST(coalesce(sum(n) FILTER (used), 0) AS BIGINT) AS taken, CAST(count(*) FILTER (used) AS INTEGER) AS n_passes, min(pos) FILTER (used) AS first_position, max(pos) FILTER (used) AS last_position
FROM q GROUP BY rid, doc_id, size, source_size, target
"""

_OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
dir AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, dir.b FROM r JOIN dir ON dir.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

_OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM rep),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {"op2_benchmark_decontamination": _OP2, "op6_minhash_dedup": _OP6, "op9_source_mixing": _OP9, "op10_substring_dedup": _OP10}
