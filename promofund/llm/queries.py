"""The registered queries of the subpackage, and their SQL where it has one."""

import corpus_pipeline
from promofund.llm.ann import op7_approximate_nearest_neighbours
from promofund.llm.divergence import op13_source_divergence_audit
from promofund.llm.line_dedup import op9_line_dedup
from promofund.llm.manifest import op12_merkle_manifest
from promofund.llm.mixing import op4_mixing_to_target_weights
from promofund.llm.ngram_join import op5_ngram_jaccard_join
from promofund.llm.packing import op10_best_fit_packing
from promofund.llm.pii import op6_pii
from promofund.llm.secret_scan import op3_secret_scan
from promofund.llm.sharding import op1_sharding
from promofund.llm.topk import op8_exact_top_k
from promofund.llm.toxicity import op2_toxicity
from promofund.llm.url_filter import op11_url_filter

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_secret_scan": op3_secret_scan,
    "op4_mixing_to_target_weights": op4_mixing_to_target_weights,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_pii": op6_pii,
    "op7_approximate_nearest_neighbours": op7_approximate_nearest_neighbours,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_line_dedup": op9_line_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_url_filter": op11_url_filter,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_divergence_audit": op13_source_divergence_audit,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS grams FROM w),
u AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS g FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 90 * (a.n + b.n - COUNT(*))),
reach AS (SELECT doc_id, doc_id AS r FROM s UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON reach.r = l.a)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, MIN(reach.r) AS component_id
FROM s JOIN reach ON s.doc_id = reach.doc_id GROUP BY s.doc_id, s.grams""",
    "op8_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM r)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM o WHERE n <= 20""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE
f AS (
  SELECT doc_id, lang, n_chars, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    -- CRC-32 of the decimal id, bit by bit: polynomial 0xEDB88320, start and final inversion 0xFFFFFFFF
    xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch:
          list_transform(range(8), lambda i: (CAST(ord(ch) AS BIGINT) >> i) & 1))),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295) AS crc
  FROM documents),
l AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS leaf,
    CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS altered
  FROM f),
g AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp, COUNT(*) OVER () AS groups FROM (SELECT DISTINCT lang FROM l)),
leaves AS (
  SELECT l.*, g.grp, g.groups, row_number() OVER w - 1 AS idx, COUNT(*) OVER (PARTITION BY g.grp) AS n
  FROM l JOIN g ON l.lang IS NOT DISTINCT FROM g.lang WINDOW w AS (PARTITION BY g.grp ORDER BY doc_id NULLS FIRST, leaf)),
low AS (
  SELECT 0 AS lvl, grp, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lvl + 1, grp, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY lvl, grp, idx // 2, n),
subroots AS (SELECT grp, h AS subroot, lvl AS levels FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, grp AS idx, groups AS n, subroot AS h FROM subroots JOIN g USING (grp)
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lvl, idx // 2, n),
-- every level on a leaf's way with its sibling there, if any
way AS (
  SELECT a.grp, a.idx, lv.lvl, sib.idx % 2 AS side, sib.h
  FROM leaves a JOIN subroots s USING (grp), unnest(range(s.levels)) lv(lvl)
  LEFT JOIN low sib ON sib.grp = a.grp AND sib.lvl = lv.lvl AND sib.idx = xor(a.idx >> lv.lvl, 1)
  UNION ALL
  SELECT a.grp, a.idx, s.levels + lv.lvl, sib.idx % 2, sib.h
  FROM leaves a JOIN subroots s USING (grp), unnest(range((SELECT MAX(lvl) FROM high))) lv(lvl)
  LEFT JOIN high sib ON sib.lvl = lv.lvl AND sib.idx = xor(a.grp >> lv.lvl, 1)),
proofs AS (SELECT grp, idx, string_agg(h, '' ORDER BY lvl) AS p, COUNT(*) AS depth FROM way GROUP BY grp, idx),
folds AS (
  SELECT grp, idx, 0 AS lvl, coalesce(altered, leaf) AS h FROM leaves
  UNION ALL
  SELECT f.grp, f.idx, f.lvl + 1, sha256(CASE WHEN w.side = 0 THEN w.h || f.h ELSE f.h || coalesce(w.h, '') END)
  FROM folds f JOIN way w ON w.grp = f.grp AND w.idx = f.idx AND w.lvl = f.lvl)
SELECT a.doc_id, a.leaf, s.subroot, r.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM leaves a JOIN subroots s USING (grp) CROSS JOIN (SELECT h FROM high WHERE n = 1) r
LEFT JOIN proofs p ON p.grp = a.grp AND p.idx = a.idx
JOIN folds f ON f.grp = a.grp AND f.idx = a.idx AND f.lvl = coalesce(p.depth, 0)""",
    "op13_source_divergence_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT k, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING COUNT(DISTINCT k) >= 3),
v AS (SELECT lang, COUNT(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, COUNT(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
tot AS (SELECT lang, source, SUM(n) AS total FROM c GROUP BY lang, source),
g AS (
  SELECT o.lang, o.source, coalesce(tot.total, 0) AS total, coalesce(v.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) o LEFT JOIN tot USING (lang, source) LEFT JOIN v USING (lang)),
cell AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v)::HUGEINT AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
lc AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (SUM(n) + 1)) // (SUM(SUM(n)) OVER (PARTITION BY lang) + COUNT(*) OVER (PARTITION BY lang))::HUGEINT AS q
  FROM cell GROUP BY lang, term),
pv AS (
  SELECT x.lang, x.source, y.source AS item, SUM(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
  FROM cell x JOIN cell y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pv.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value
  FROM cell JOIN lc USING (lang, term) WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS n
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, CAST(n AS INTEGER) AS rank FROM r WHERE part = 'pair' OR n <= 200""",
}
