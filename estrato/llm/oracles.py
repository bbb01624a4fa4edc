"""SQL twins of the operators that SQL can express, for DuckDB."""

REPEATED_PASSAGES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
starts AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
passages AS (SELECT s.r, s.i, array_to_string(d.w[s.i : s.i + 34], ' ') AS p FROM starts s JOIN d USING (r)),
repeated AS (SELECT p FROM passages GROUP BY p HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + unnest(range(35)) AS i FROM passages JOIN repeated USING (p)),
lost AS (SELECT r, list(i) AS places, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lost USING (r)
"""

EXACT_TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT DISTINCT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE label = own),
hard AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM near p JOIN s n ON n.anchor_id = p.anchor_id AND n.label <> n.own
  WHERE p.place <= 5 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 3
"""

FILL_IN_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
h AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
p AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(u[greatest(a, b) + 1:], '') AS suffix
  FROM h
)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
