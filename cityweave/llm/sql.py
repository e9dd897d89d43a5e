"""DuckDB SQL of the queries that SQL can express."""

from cityweave.llm.secret_scan import BASE_RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_scan() -> str:
    scans = " UNION ALL ".join(
        f"SELECT text, {k} AS k, '{r.name}' AS kind, {r.least} AS least, string_split_regex(text, {_quoted(r.pattern)}) AS gaps, "
        f"regexp_extract_all(text, {_quoted(r.pattern)}, 0) AS wholes, regexp_extract_all(text, {_quoted(r.pattern)}, {r.group}) AS parts "
        f"FROM blobs WHERE regexp_matches(text, {_quoted(r.pattern)})"
        for k, r in enumerate(BASE_RULES)
    )
    return f"""
WITH blobs AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
scans AS ({scans}),
matches AS (
  SELECT text, k, kind, least, generate_subscripts(wholes, 1) AS i, length(unnest(gaps[1:len(wholes)])) AS gap,
         length(unnest(wholes)) AS whole, length(unnest(parts)) AS part
  FROM scans),
spans AS (
  SELECT text, k, kind, least, part, whole, sum(gap + whole) OVER (PARTITION BY text, k ORDER BY i) AS upto FROM matches),
by_blob AS (
  SELECT text, string_agg(kind || ':' || (upto - whole)::BIGINT || ':' || upto::BIGINT, ',' ORDER BY upto - whole, k) AS spans,
         count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex
  FROM spans WHERE part >= least GROUP BY text)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents AS d LEFT JOIN by_blob AS b ON coalesce(d.text, '') = b.text"""


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 10"""

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT rid, i, dw.n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k),
hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN named USING (rid)"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

ORACLE_SQL = {
    "op5_secret_scan": _secret_scan(),
    "op8_exact_topk": TOP_K,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_decontamination": DECONTAMINATION,
}
