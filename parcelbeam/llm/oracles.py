"""DuckDB SQL for the corpus queries that SQL can express.

The others are held against brute force in the tests: 1 (fitted model), 3 and 10 (tokenizer),
4 (positions of matches), 5 (approximate alignment), 6 and 8 (fitted models), 11 and 12 (tokenizers).
"""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '{WORDS}') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS same FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN c cx ON cx.doc_id = p.x JOIN c cy ON cy.doc_id = p.y WHERE 100 * o >= 80 * (cx.n + cy.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id),
k AS (SELECT same, min(doc_id) AS class_id FROM c GROUP BY same)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(k.class_id, d.doc_id) AS class_id, m.component_id
FROM documents d JOIN m USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k USING (same)
"""

TOP_K = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS ask, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.ask, q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v, true), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY ask ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight FROM s),
-- from the smallest size per weight: a source is capped while its share of the rest passes 3 times its size
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(source_size) OVER before, 0) AS size_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM w WINDOW before AS (ORDER BY source_size / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, weight * (total - 3 * size_before) > 3 * source_size * (weights - weight_before) AS capped FROM o),
f AS (
  SELECT *, total - 3 * coalesce(sum(source_size) FILTER (WHERE capped) OVER (), 0) AS rest,
    weights - coalesce(sum(weight) FILTER (WHERE capped) OVER (), 0) AS open_weight FROM c),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(weight AS DOUBLE) * CAST(rest AS DOUBLE) / CAST(open_weight AS DOUBLE) END AS target FROM f),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(t.target / nullif(t.source_size, 0), 0) AS rate,
    CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM n
"""

#: One round: every vector's nearest centroid, and the next centroids.
ROUND = """
a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, best[1] AS distance, best[2] AS cluster FROM (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v,
      min([CAST(list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT), cluster]) AS best
    FROM v CROSS JOIN c{i} GROUP BY r)),
c{j} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY place) AS c FROM (
      SELECT cluster, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY cluster, place)
    GROUP BY cluster) m USING (cluster)),"""

CLUSTERS = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS cluster, v AS c
  FROM v QUALIFY cluster < 40),
""" + "".join(ROUND.format(i=i, j=i + 1) for i in range(6)) + """
t AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a5 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, cluster_inertia,
  (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM t) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a5 JOIN t USING (cluster) JOIN c5 USING (cluster)
"""

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard_join": JACCARD,
    "op7_exact_top_k": TOP_K,
    "op9_source_mixing": MIXING,
    "op13_centroid_clustering": CLUSTERS,
}
