"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(s)),
found AS (SELECT r, s, n, item_id FROM places JOIN windows USING (n, k)),
hit AS (SELECT r, count(DISTINCT s + i) AS n_hit FROM (SELECT DISTINCT r, s, n FROM found), unnest(range(0, n)) AS u(i) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

OP5 = """
WITH u AS (SELECT page_id, url, html, row_number() OVER () AS r FROM pages),
own AS (
  SELECT *, translate(regexp_extract(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h0 FROM u),
bad AS (
  SELECT *, regexp_matches(h0, '(^|[.])(spam-farm|cheap-pills)[.]') AS site FROM own
  WHERE regexp_matches(h0, '(^|[.])(spam-farm|cheap-pills)[.]')
    OR len(regexp_extract_all(regexp_extract(html, '<title>([^<]*)</title>', 1), '[%*#$]{3}')) >= 2),
links AS (SELECT h0, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS t FROM bad WHERE site),
everything AS (
  SELECT r, page_id, url FROM u UNION ALL SELECT NULL, NULL, url FROM bad
  UNION ALL SELECT NULL, NULL, CASE WHEN instr(t, '://') > 0 THEN t WHEN starts_with(t, '/') THEN 'http://' || h0 || t END FROM links),
a AS (
  SELECT r, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS s FROM everything),
p AS (
  SELECT r, page_id, translate(regexp_extract(s, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
e AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)[.]', '')
    || regexp_replace(regexp_replace(path, '[.]html$', ''), '/$', '') END AS canon FROM p),
listed AS (SELECT DISTINCT canon FROM e WHERE r IS NULL),
c AS (SELECT * FROM e WHERE r IS NOT NULL),
rules(verdict, h, t) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT r, max_by(h || t, length(h || t)) AS rule, max_by(verdict, length(h || t)) AS v FROM c, rules
  WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, t) GROUP BY r)
SELECT page_id, host, path, rule,
  coalesce(v, CASE WHEN canon IN (SELECT canon FROM listed WHERE canon IS NOT NULL) THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN best USING (r)
"""

OP6 = """
WITH RECURSIVE c AS (
  SELECT *, conv_id || ':' || turn AS own, conv_id || ':' || (turn - 1) AS asked, CAST(to_json(text) AS VARCHAR) AS j,
    length(text) % 5 AS fault, CASE length(text) % 8 WHEN 0 THEN [turn + 2] WHEN 1 THEN [turn - 2, turn + 2] WHEN 2 THEN [turn - 2]
      WHEN 3 THEN [turn - 2] ELSE [] END AS needs FROM conversations),
e AS (
  SELECT a.conv_id, a.turn AS a, b.turn AS b FROM (SELECT conv_id, turn, unnest(needs) AS need FROM c WHERE role = 'user') a
  JOIN c b ON b.conv_id = a.conv_id AND b.turn = a.need AND b.role = 'user'),
paths AS (
  SELECT conv_id, turn AS s, turn AS here, 0 AS steps, [turn] AS seen, false AS cycle FROM c WHERE role = 'user'
  UNION ALL SELECT p.conv_id, s, b, steps + CASE WHEN b >= here THEN 1 ELSE 0 END, list_append(seen, b), list_contains(seen, b)
  FROM paths p JOIN e ON e.conv_id = p.conv_id AND a = here WHERE NOT cycle),
levels AS (SELECT conv_id, s, CAST(CASE WHEN bool_or(cycle) THEN -1 ELSE max(steps) END AS INTEGER) AS level FROM paths GROUP BY ALL),
answers AS (SELECT conv_id, asked, min(turn) AS answered FROM c WHERE role = 'assistant' GROUP BY ALL)
SELECT c.conv_id, turn, 0 AS place, 'message' AS kind, NULL AS call_id, 'plain' AS status, '' AS problems, 0 AS level,
  '{"content":' || j || ',"role":"' || role || '","type":"message"}' AS record
FROM c WHERE role NOT IN ('user', 'assistant')
UNION ALL
SELECT c.conv_id, turn, 0, 'call', own, CASE WHEN answered IS NULL THEN 'unanswered' ELSE 'linked' END,
  CASE fault WHEN 0 THEN 'turn is no integer' WHEN 1 THEN 'unknown note' WHEN 2 THEN 'missing message' WHEN 3 THEN 'no object' ELSE '' END,
  level, CASE fault WHEN 0 THEN '{"arguments":{"message":' || j || ',"turn":"' || turn || '"}'
    WHEN 1 THEN '{"arguments":{"message":' || j || ',"note":true,"turn":' || turn || '}' WHEN 2 THEN '{"arguments":{"turn":' || turn || '}'
    WHEN 3 THEN '{"arguments_text":"turn ' || turn || '"' ELSE '{"arguments":{"message":' || j || ',"turn":' || turn || '}' END
  || ',"id":"' || own || '","name":"reply","type":"tool_call"}'
FROM c JOIN levels l ON l.conv_id = c.conv_id AND l.s = c.turn LEFT JOIN answers a ON a.conv_id = c.conv_id AND a.asked = c.own WHERE role = 'user'
UNION ALL
SELECT c.conv_id, turn, 0, 'result', c.asked, CASE WHEN l.level IS NULL THEN 'orphan' ELSE 'linked' END, '', coalesce(l.level, 0),
  '{"content":' || j || ',"id":"' || c.asked || '","type":"tool_result"}'
FROM c LEFT JOIN levels l ON l.conv_id = c.conv_id AND l.s = c.turn - 1 WHERE role = 'assistant'
"""

OP7 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
places AS (SELECT r, s, array_to_string(w[s:s + 34], ' ') AS k FROM d, unnest(range(1, len(w) - 33)) AS u(s)),
twice AS (SELECT k FROM places GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, s + i AS p FROM places JOIN twice USING (k), unnest(range(0, 35)) AS u(i)),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
words AS (SELECT r, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""

OP8 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + least(3, len(w)) - 1], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(s) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM inter JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""

OP11 = """
WITH p AS (
  SELECT row_number() OVER (ORDER BY page_id, url) AS r, page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest, min(r) AS first_r, arg_min(page_id, r) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_r IS NULL OR r = first_r THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN r <> first_r THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP12 = """
WITH RECURSIVE remainders AS (
  SELECT list(list_reduce(list_prepend(i, range(0, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
    ORDER BY i) AS t FROM range(0, 256) AS u(i)),
found AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]{7,}')) AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(b)), lambda k:
    CAST('0x' || substr(hex(b), 2 * k + 1, 2) AS BIGINT))), lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1])), 4294967295) AS h
  FROM (SELECT run, n, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS b FROM runs), remainders),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gone AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM w, unnest(range(1, length(word) + 1)) AS u(i)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM gone a JOIN gone b ON a.i = b.i AND a.k = b.k AND a.word <> b.word
  UNION SELECT w.word, gone.word FROM w JOIN gone ON gone.k = w.word UNION SELECT gone.word, w.word FROM w JOIN gone ON gone.k = w.word),
ranked AS (
  SELECT a, b, n AS bn, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k
  FROM pairs JOIN w ON w.word = b),
best AS MATERIALIZED (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 10 * n THEN b END AS form, CASE WHEN bn >= 10 * n THEN bn END AS form_n
  FROM w LEFT JOIN ranked ON a = w.word AND k = 1),
chain AS (
  SELECT word, word AS here, 0 AS steps FROM best
  UNION ALL SELECT chain.word, best.form, steps + 1 FROM chain JOIN best ON best.word = here WHERE best.form IS NOT NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM best JOIN (SELECT word, arg_max(here, steps) AS root FROM chain GROUP BY word) USING (word)
"""

OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM x GROUP BY ALL HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS c FROM x SEMI JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(total) AS HUGEINT) AS n FROM kept GROUP BY lang),
gn AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
grid AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 2)) // (CAST(coalesce(gn.n, 0) AS HUGEINT) + 2 * v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (total + 2)) // (l.n + 2 * v) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN gn USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM grid WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1,
    "op5_url_filter": OP5,
    "op6_chat": OP6,
    "op7_substring_dedup": OP7,
    "op8_minhash": OP8,
    "op11_warc": OP11,
    "op12_spelling_variants": OP12,
    "op13_source_divergence": OP13,
}
