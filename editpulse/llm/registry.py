"""Registered queries of the training-data operators, and the DuckDB SQL of
those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from editpulse.llm import bitslice, bpe, fingerprint, hardneg, jaccard, linededup, packing, suffixindex, superkmer, toxicity, urlfilter, warc, whitening

QUERIES = {
    "op1_warc_derivatives": warc.op1_warc_derivatives,
    "op2_suffix_array_dedup": suffixindex.op2_suffix_array_dedup,
    "op3_exact_top_k": bitslice.op3_exact_top_k,
    "op4_url_filter": urlfilter.op4_url_filter,
    "op5_bpe": bpe.op5_bpe,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_packing": packing.op7_packing,
    "op8_substring_dedup": superkmer.op8_substring_dedup,
    "op9_fingerprints": fingerprint.op9_fingerprints,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_line_dedup": linededup.op11_line_dedup,
    "op12_hard_negatives": hardneg.op12_hard_negatives,
    "op13_whitening": whitening.op13_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {}

_UUID = "concat('<urn:uuid:', substr({0}, 1, 8), '-', substr({0}, 9, 4), '-', substr({0}, 13, 4), '-', substr({0}, 17, 4), '-', substr({0}, 21), '>')"
_TIDY = r"""trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'),
 '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '[ \t\r\f\v\x{{00a0}}]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))"""
_SILENT = "page0"
for _t in ("script", "style", "noscript", "template"):
    _SILENT = rf"regexp_replace({_SILENT}, '(?is)<{_t}\b.*?(?:</{_t}\s*>|\z)', ' ', 'g')"

# The entities are those that the pages hold.
ORACLE["op1_warc_derivatives"] = rf"""
WITH r AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS page,
  'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) AS head FROM pages),
s AS (SELECT *, md5('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || target_uri || '|' || page) AS k,
  'sha256:' || sha256(page) AS payload_digest, 'sha256:' || sha256(head || chr(13) || chr(10) || chr(13) || chr(10) || page) AS source_digest,
  regexp_replace(page, '(?s)<!--.*?(?:-->|\z)', ' ', 'g') AS page0 FROM r),
t AS (SELECT *, {_UUID.format("k")} AS refers_to FROM s),
u AS (SELECT *, md5('conversion|' || refers_to) AS ck, md5('metadata|' || refers_to) AS mk,
  {_TIDY.format(rf"regexp_replace(regexp_replace({_SILENT}, '(?i)</?(?:p|div|br|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|article|section|header|footer|nav|title|blockquote|pre|form|hr|main|aside)\b[^>]*(?:>|\z)', chr(10), 'g'), '<[a-zA-Z/!?][^>]*(?:>|\z)', '', 'g')")} AS body,
  replace({_TIDY.format(r"regexp_replace(regexp_extract(page, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '<[a-zA-Z/!?][^>]*(?:>|\z)', '', 'g')")}, chr(10), ' ') AS title,
  len(regexp_extract_all(page, '(?i)<a\b[^>]*\bhref\s*=')) AS links FROM t),
v AS (SELECT page_id, 'conversion' AS warc_type, {_UUID.format("ck")} AS record_id, refers_to, target_uri, payload_digest, 'text/plain; charset=utf-8' AS content_type, body AS block FROM u
  UNION ALL SELECT page_id, 'metadata', {_UUID.format("mk")}, refers_to, target_uri, payload_digest, 'application/warc-fields',
  'conversion: ' || {_UUID.format("ck")} || chr(13) || chr(10) || 'source-block-digest: ' || source_digest || chr(13) || chr(10) || 'source-payload-digest: ' || payload_digest || chr(13) || chr(10)
  || 'http-status: ' || replace(head, chr(13) || chr(10), chr(13) || chr(10) || 'http-header: ') || chr(13) || chr(10) || 'title: ' || title || chr(13) || chr(10) || 'links: ' || links || chr(13) || chr(10) FROM u)
SELECT page_id, warc_type, record_id, refers_to, target_uri, '2024-01-01T00:00:00Z' AS date, content_type, CAST(strlen(block) AS BIGINT) AS content_length,
  'sha256:' || sha256(block) AS block_digest, payload_digest AS source_payload_digest, true AS digest_ok, block FROM v
"""

ORACLE["op3_exact_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op4_url_filter"] = r"""
WITH p AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(h, s, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT page_id, host, path, max_by(h || s, len(h || s)) AS rule, max_by(v, len(h || s)) AS verdict
  FROM q LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY page_id, host, path)
SELECT q.page_id, q.host, q.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM q JOIN f USING (page_id, host, path)
"""

# Bytes as hexadecimal digits, two a byte.
ORACLE["op2_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
win AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS s
        FROM (SELECT doc_id, x, unnest(range(0, CAST(len(x) / 2 AS BIGINT) - 99)) AS i FROM d WHERE len(x) >= 200)),
low AS (SELECT s, min(struct_pack(doc_id := doc_id, i := i)) AS m FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win JOIN low USING (s) WHERE doc_id <> m.doc_id OR i <> m.i),
edge AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 100, true) AS fresh FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
span AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b
         FROM (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM edge) GROUP BY doc_id, k),
piece AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS frm, a AS upto FROM span
          UNION ALL SELECT doc_id, 9000000000000000000, max(b), 1000000000 FROM span GROUP BY doc_id),
kept AS (SELECT p.doc_id, string_agg(substr(x, 2 * frm + 1, 2 * (upto - frm)), '' ORDER BY a) AS k FROM piece p JOIN d USING (doc_id) GROUP BY p.doc_id),
n AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(len(x) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.k, x))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE["op8_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN low USING (s) WHERE doc_id > m),
g AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id),
kept AS (SELECT d.doc_id, count(*) AS n, string_agg(u.word, ' ' ORDER BY u.j) AS k
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d) u
         JOIN d ON d.doc_id = u.doc_id
         WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = u.doc_id AND gone.j = u.j) GROUP BY d.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g.js), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.k, '')) AS kept_sha256
FROM d LEFT JOIN g ON g.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


# Candidate pairs share a prefix shingle in the order of document frequencies;
# every pair of distinct sets so found is compared whole.
ORACLE["op6_jaccard_join"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
t AS (SELECT doc_id, len(x) AS n, unnest(x) AS g FROM s),
f AS (SELECT g, count(*) AS df FROM t GROUP BY g HAVING count(*) > 1),
r AS (SELECT doc_id, n, t.g, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(df, 1), t.g) AS pos FROM t LEFT JOIN f USING (g)),
p AS (SELECT * FROM r JOIN f USING (g) WHERE pos <= n - (80 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.doc_id AS u, b.doc_id AS v, a.n AS m, b.n AS n FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
o AS (SELECT u, v, any_value(c.m) AS m, any_value(c.n) AS n, count(*) AS k FROM c JOIN r a ON a.doc_id = u JOIN r b ON b.doc_id = v AND b.g = a.g GROUP BY u, v),
e AS (SELECT u, v FROM o WHERE 100 * k >= 80 * (m + n - k) UNION ALL SELECT v, u FROM o WHERE 100 * k >= 80 * (m + n - k)),
walk(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.v, root FROM walk JOIN e ON e.u = walk.doc_id),
low AS (SELECT doc_id, min(root) AS component_id FROM walk GROUP BY doc_id)
SELECT doc_id, CAST(len(x) AS BIGINT) AS n_shingles, component_id FROM s JOIN low USING (doc_id)
"""

ORACLE["op11_line_dedup"] = """
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(x) AS line, unnest(range(1, len(x) + 1)) AS pos FROM t),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id <> last) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last IS NULL OR doc_id = last), '')) AS kept_sha256
FROM k LEFT JOIN o USING (key) GROUP BY doc_id
"""

ORACLE["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT * FROM n WHERE rank <= 5
"""


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
