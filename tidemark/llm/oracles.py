"""The same results in SQL of a second engine, for the training-data queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.exact_dedup import LOWER, UPPER

LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

ORACLES: dict[str, str] = {
    "op7_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
 WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
reach(node, r) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.r),
low AS (SELECT node, min(r) AS component FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(low.component, e.vec_id) AS component_id,
 coalesce(low.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN low ON low.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op8_exact_dedup": f"""WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents),
g AS (SELECT doc_id, text_sha256, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
 count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op9_ngram_join": rf"""WITH RECURSIVE w AS (SELECT doc_id,
 list_filter(string_split_regex({LOWERED}, '[ \t\n\r\x0b\x0c]+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, chr(1))]
 ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], chr(1))) END)) AS gram FROM w),
s AS (SELECT doc_id, count(*) AS n, md5(string_agg(gram, chr(2) ORDER BY gram)) AS k FROM g GROUP BY doc_id),
c AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY k) AS copy_id, count(*) OVER (PARTITION BY k) AS size FROM s),
rep AS (SELECT doc_id, n, size FROM c WHERE doc_id = copy_id),
rg AS (SELECT g.doc_id, gram FROM g JOIN rep USING (doc_id)),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM rg x JOIN rg y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b, y.size FROM p JOIN rep x ON x.doc_id = a JOIN rep y ON y.doc_id = b WHERE shared >= 0.8 * (x.n + y.n - shared)),
reach(node, r) AS (SELECT doc_id, doc_id FROM rep UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.r),
low AS (SELECT node, min(r) AS class_id FROM reach GROUP BY node),
near AS (SELECT a, sum(size) AS near FROM links GROUP BY a)
SELECT d.doc_id, coalesce(low.class_id, d.doc_id) AS class_id, coalesce(c.copy_id, d.doc_id) AS copy_id,
 CAST(coalesce(c.size - 1, 0) + coalesce(near.near, 0) AS BIGINT) AS n_links, coalesce(low.class_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN low ON low.node = c.copy_id LEFT JOIN near ON near.a = c.copy_id""",
    "op11_hard_negatives": """WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
 list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS q FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
 id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3""",
}
