"""DuckDB SQL for the queries of this subpackage that SQL can express."""

#: Base32 digit i of a SHA-1 in hex: five bits from the two hex digits that hold them.
_OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT x, min(page_id) AS m FROM p GROUP BY x)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    (16 * (instr('0123456789abcdef', substr(x, (5 * i) // 4 + 1, 1)) - 1)
      + instr('0123456789abcdef', substr(x, (5 * i) // 4 + 2, 1)) - 1) >> (3 - (5 * i) % 4)) & 31)::INT, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> m THEN m END AS refers_to, true AS payload_ok
FROM p JOIN f USING (x)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Sets of 5-word shingles, all pairs that share one, and what links reach.
_OP4 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM d),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS root FROM s UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a),
k AS (SELECT doc_id, md5(array_to_string(list_sort(g), chr(10))) AS key FROM s),
f AS (SELECT key, min(doc_id) AS class_first FROM k GROUP BY key)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, c.component_id,
  CASE WHEN len(g) > 0 THEN f.class_first ELSE s.doc_id END AS class_first
FROM s JOIN (SELECT id, min(root) AS component_id FROM r GROUP BY id) c ON c.id = s.doc_id
JOIN k ON k.doc_id = s.doc_id JOIN f USING (key)
"""

_OP6_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_OP6 = f"""
WITH d AS (SELECT doc_id, {_OP6_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_OP6_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) t(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM win) m, unnest(range(1, len(w) - n + 2)) t(i)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN win USING (g, n)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM hits) GROUP BY doc_id),
q AS (SELECT DISTINCT item_id, w[i:i + 9] AS q FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) t(i) WHERE len(w) > 0),
places AS (SELECT doc_id, w[i] AS x, list_concat(['', ''], w)[i:i + 13] AS c FROM d, unnest(range(1, len(w) + 1)) t(i)),
near AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM places JOIN q ON q[1] = x
  WHERE item_id IS NOT NULL AND {" AND ".join(f"(len(q) <= {j} OR list_contains(c[{j + 1}:{j + 5}], q[{j + 1}]))" for j in range(1, 10))}),
near_it AS (SELECT doc_id, count(*) AS n_near, string_agg(v, ',' ORDER BY v) AS near_ids
  FROM near ANTI JOIN (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM hits) h USING (doc_id, v) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0)::BIGINT AS n_near_items, sha256(coalesce(near_ids, '')) AS near_items_sha256
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN near_it USING (doc_id)
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_URL = "'(?s)^.*?://([^/?#]*)([^?#]*)'"


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR suffix(host, '.{host}')) AND prefix(path, '{path}')"


def _order(k: int) -> str:
    """Chances of each window's last character after its last k characters."""
    return f"""
p{k} AS (SELECT w,
  CASE WHEN coalesce(ha, 0) < 4 THEN a ELSE (coalesce(ga, 0) + ta * a) / (ha + ta) END AS a,
  CASE WHEN coalesce(hb, 0) < 4 THEN b ELSE (coalesce(gb, 0) + tb * b) / (hb + tb) END AS b
  FROM p{k - 1} LEFT JOIN t ON t.g = right(w, {k + 1}) LEFT JOIN c ON c.h = left(right(w, {k + 1}), {k})),"""


#: Rules, counts of grams, five orders of smoothing, mean log-ratios, threshold.
_OP13 = f"""
WITH u AS (SELECT DISTINCT coalesce(url, '') AS url FROM pages),
n AS (SELECT url, translate(regexp_extract(url, {_URL}, 1), {_AZ}) AS host, regexp_extract(url, {_URL}, 2) AS path FROM u),
r AS (SELECT *, CASE WHEN {_fits('example.org', '/en/1')} THEN 'example.org/en/1'
  WHEN {_fits('example.org', '/es/')} THEN 'example.org/es/' WHEN {_fits('com', '/fr/')} THEN 'com/fr/'
  WHEN {_fits('com', '/de/')} THEN 'com/de/' WHEN {_fits('org', '/')} THEN 'org/' END AS rule FROM n),
l AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS label,
  substr(md5(url), 1, 1) < '4' AS kept, repeat(chr(2), 4) || translate(url, {_AZ}) || chr(3) AS padded FROM r),
x AS (SELECT url, label, kept, substr(padded, i, 5) AS w FROM l, unnest(range(1, length(url) + 2)) q(i)),
t AS (SELECT right(w, k) AS g, count(*) FILTER (label = 'allow') AS ga, count(*) FILTER (label = 'block') AS gb
  FROM x, range(1, 6) q(k) WHERE label IS NOT NULL AND NOT kept GROUP BY ALL),
c AS (SELECT left(g, length(g) - 1) AS h, sum(ga) AS ha, count(*) FILTER (ga > 0) AS ta, sum(gb) AS hb,
  count(*) FILTER (gb > 0) AS tb FROM t GROUP BY ALL),
p AS (SELECT DISTINCT w, 1.0::DOUBLE / (v + 1) AS a, 1.0::DOUBLE / (v + 1) AS b
  FROM x, (SELECT count(*) AS v FROM t WHERE length(g) = 1)),
p0 AS (SELECT w,
  CASE WHEN coalesce(ha, 0) < 4 THEN a ELSE (coalesce(ga, 0) + ta * a) / (ha + ta) END AS a,
  CASE WHEN coalesce(hb, 0) < 4 THEN b ELSE (coalesce(gb, 0) + tb * b) / (hb + tb) END AS b
  FROM p LEFT JOIN t ON t.g = right(w, 1) LEFT JOIN c ON c.h = ''),{''.join(_order(k) for k in range(1, 5))}
s AS (SELECT url, floor(sum(round((ln(a) - ln(b)) * 1e6)::BIGINT) / count(*))::BIGINT AS score
  FROM x JOIN p4 USING (w) WHERE label IS NULL OR kept GROUP BY url),
k AS (SELECT label, floor(score / 10000)::BIGINT AS bin FROM s JOIN l USING (url) WHERE label IS NOT NULL),
z AS (SELECT count(*) FILTER (label = 'allow') AS n_a, count(*) FILTER (label = 'block') AS n_b FROM k),
b AS (SELECT m.bin, (SELECT count(*) FROM k WHERE label = 'allow' AND k.bin >= m.bin) / n_a
    + (SELECT count(*) FROM k WHERE label = 'block' AND k.bin < m.bin) / n_b AS good
  FROM (SELECT DISTINCT bin FROM k) m, z WHERE n_a > 0 AND n_b > 0),
cut AS (SELECT coalesce((SELECT bin FROM b ORDER BY good DESC, abs(bin), bin LIMIT 1), 0) * 10000 AS least,
  (SELECT count(DISTINCT label) FROM l WHERE NOT kept) = 2 AS two)
SELECT page_id, l.host, l.path, l.rule,
  coalesce(l.label, CASE WHEN two AND score < least THEN 'block' ELSE 'allow' END) AS verdict, score
FROM pages JOIN l ON l.url = coalesce(pages.url, '') LEFT JOIN s ON s.url = l.url, cut
"""

#: crc32 of a decimal number, bit by bit over its bytes, lowest bit first.
def _crc32(x: str) -> str:
    bits = (f"flatten(list_transform(string_split(CAST({x} AS VARCHAR), ''), "
            "lambda ch: list_transform(range(8), lambda i: (ascii(ch) >> i) & 1)))")
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), "
            "lambda a, b: xor(a >> 1, CASE WHEN (xor(a, b) & 1) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)")


#: A node's key is the digests of its turns in a row; left(key, 32 * d) is its ancestor of depth d.
_OP11 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, length(coalesce(text, '')) AS chars,
  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, k) AS pos FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('conv_id')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
q AS (SELECT c.conv_id, 0 AS part, pos, k, chars FROM c JOIN o ON o.conv_id = base AND pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, k, chars FROM c JOIN o ON o.conv_id = c.conv_id AND pos > h),
p AS (SELECT conv_id, chars, row_number() OVER w AS depth, string_agg(k, '') OVER w AS key FROM q
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY conv_id),
n AS (SELECT key, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS own,
  sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM p JOIN e USING (conv_id) GROUP BY key, depth),
k AS (SELECT depth - 1 AS depth, left(key, 32 * (depth - 1)) AS key, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM n LEFT JOIN k USING (depth, key)),
s AS (SELECT left(key, 32 * d) AS key, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM f, unnest(range(depth + 1)) u(d) GROUP BY ALL)
SELECT f.conv_id, f.depth, a.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM f JOIN s USING (key, depth) LEFT JOIN n a ON a.depth = f.depth - 1 AND a.key = left(f.key, 32 * (f.depth - 1))
"""

_OP12_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_OP12 = f"""
WITH d AS (SELECT doc_id, {_OP12_TERMS} AS w FROM documents),
k AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({_OP12_TERMS}) AS t FROM benchmark),
p AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT row_number() OVER () AS row, doc_id, len(w) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY row, doc_id, n, t),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
g AS (SELECT doc_id, t, (floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
  * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // length))))::BIGINT AS part FROM p JOIN f USING (t), k),
s AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM q JOIN g USING (t) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""

SQL: dict[str, str] = {
    "op4_token_groups": _OP4,
    "op6_positional_index": _OP6,
    "op9_splittable_warc": _OP9,
    "op11_prefix_trie": _OP11,
    "op12_shared_search": _OP12,
    "op13_url_markov": _OP13,
}
