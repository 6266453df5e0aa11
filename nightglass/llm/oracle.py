"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all(coalesce({_LOWER}, ''), '{_CLASS}')"

ORACLE["op2_decontam"] = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, len(g) AS n, array_to_string(g, ' ') AS gram FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: w[i:least(i + 12, len(w))])) AS g FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'pos': i, 'gram': array_to_string(w[i:i + n - 1], ' ')}}), recursive := true) FROM docs, sizes WHERE len(w) >= n),
hits AS (
  SELECT p.doc_id, p.pos, p.n, g.item_id FROM places p JOIN grams g ON g.n = p.n AND p.gram = g.gram),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_SPACE = r"[^\x20\x09-\x0D]+"
ORACLE["op7_quality"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACE}')) AS lines FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: {{'i': i, 'g': array_to_string(w[i:i + 4], ' ')}}), recursive := true) FROM d),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS BIGINT) AS n_stutter FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END)
             + (CASE WHEN 100 * n_stutter > 25 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END) AS INTEGER) AS bits FROM m)
SELECT *, bits & 3 <> 0 AS base_failed, bits = 0 AS kept FROM b
"""

_CONTROL = r"(\\*)(### |</turn>)"
ORACLE["op8_chat"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(4 + length(regexp_replace(regexp_replace(role, '([\\:])', '\\\1', 'g'), '{_CONTROL}', '\\\1\2', 'g')) + 2
                + length(regexp_replace(text, '{_CONTROL}', '\\\1\2', 'g')) + 9) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLE["op11_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""

ORACLE["op12_subtrees"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS n FROM s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM f WHERE n > 1),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM x ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id),
spans AS (SELECT doc_id, count(*) AS n FROM gone g ANTI JOIN (SELECT doc_id, k + 1 AS k FROM gone) b USING (doc_id, k) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(counts.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, coalesce(spans.n, 0) AS n_spans
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id) LEFT JOIN counts USING (doc_id)
"""
