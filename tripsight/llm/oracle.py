"""DuckDB SQL of the training-data queries that SQL can express."""

SQL = {
    "op7_patricia_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
""",
}

SQL["op4_phrase_automata"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS s, words FROM w WHERE len(words) >= 20
), k AS (
  SELECT doc_id, s, sha256(array_to_string(list_slice(words, s, s + 19), ' ')) AS seq FROM p
), f AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) AS nth FROM k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM f WHERE nth > 1
), each AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w
), kept AS (
  SELECT each.doc_id, string_agg(each.word, ' ' ORDER BY each.i) AS t, count(*) AS n
  FROM each ANTI JOIN gone ON each.doc_id = gone.doc_id AND each.i = gone.i GROUP BY each.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words,
       CAST(len(w.words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

SQL["op2_minhash_bayes"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
hits AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT hits.a, hits.b FROM hits JOIN n x ON x.doc_id = hits.a JOIN n y ON y.doc_id = hits.b
  WHERE 100 * hits.c >= 75 * (x.n + y.n - hits.c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

# weights 1, 2, 3 are the integrals of schedules that fade (1.5 to 0.5), hold (2) and rise (2 to 3 to 4)
SQL["op11_curriculum"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source
), c AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS words,
         coalesce(sum(3 * source_size) OVER o, 0) AS cap_before, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_open
  FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), j AS (SELECT *, w * (words - cap_before) > cap * w_open AS capped FROM c),
r AS (
  SELECT words - coalesce(sum(cap) FILTER (capped), 0) AS rest, sum(w) FILTER (NOT capped) AS w_rest FROM j GROUP BY words
), t AS (
  SELECT source, source_size, w, CASE WHEN capped THEN CAST(cap AS DOUBLE)
         ELSE least(CAST(cap AS DOUBLE), coalesce(CAST(w AS DOUBLE) * CAST(rest AS DOUBLE) / w_rest, 0)) END AS target
  FROM j, r
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.w, CAST(floor(t.target) AS BIGINT) AS lim,
         coalesce(CAST(sum(d.size) OVER (PARTITION BY t.source ORDER BY d.drawn, d.doc_id NULLS LAST, d.size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS b
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, least(greatest(lim - b, 0), size) + least(greatest(lim - b - source_size, 0), size)
         + least(greatest(lim - b - 2 * source_size, 0), size) AS taken, CAST(b AS DOUBLE) / nullif(target, 0) AS y FROM p
), q AS (
  SELECT *, CASE w WHEN 1 THEN y WHEN 2 THEN y * 2.0 ELSE y * 3.0 END AS a FROM k
)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN least(greatest(lim - b, 0), size) = 0 THEN NULL
            WHEN w = 1 THEN least(2 * a / (CAST(1.5 AS DOUBLE) + sqrt(CAST(2.25 AS DOUBLE) - 2 * a)), 1.0)
            WHEN w = 2 THEN least(2 * a / (CAST(2 AS DOUBLE) + sqrt(CAST(4 AS DOUBLE))), 1.0)
            WHEN a < 1.25 THEN 2 * a / (CAST(2 AS DOUBLE) + sqrt(CAST(4 AS DOUBLE) + 4 * a))
            ELSE least(CAST(0.5 AS DOUBLE) + 2 * (a - CAST(1.25 AS DOUBLE))
                       / (CAST(3 AS DOUBLE) + sqrt(CAST(9 AS DOUBLE) + 4 * (a - CAST(1.25 AS DOUBLE)))), 1.0)
       END AS first_position
FROM q
"""

SQL["op13_tree_negatives"] = """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, c.id, c.label,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e a JOIN e c ON a.id <> c.id WHERE a.id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
