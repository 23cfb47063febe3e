"""DuckDB SQL with the results of the training-data queries that SQL can express.

The others fit a model, draw at random or use hashes that DuckDB lacks; their tests compare
with brute force in Python.
"""

from __future__ import annotations

SPLIT = "list_filter(regexp_split_to_array({}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

JACCARD = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {SPLIT.format(f"translate(ifnull(text, ''), '{UPPER}', '{LOWER}')")} AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        END) AS g
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
    SELECT x.a, x.b FROM (
        SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared
        FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2) x
    JOIN n p ON p.doc_id = x.a JOIN n q ON q.doc_id = x.b
    WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
r AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, ifnull(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id
"""

PHRASES = f"""
WITH w AS (SELECT doc_id, {SPLIT.format("ifnull(text, '')")} AS w FROM documents),
g AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g),
c AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
    FROM g JOIN f USING (g) WHERE doc_id > low),
x AS (SELECT doc_id, list(p) AS p FROM c GROUP BY doc_id),
k AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
    FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w)
    ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, CAST(ifnull(len(x.p), 0) AS BIGINT) AS n_removed,
       sha256(ifnull(kept, '')) AS kept_sha256
FROM w LEFT JOIN x USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def _base32(digest: str) -> str:
    digits = []
    for group in range(8):
        value = f"CAST('0x' || substr({digest}, {5 * group + 1}, 5) AS INTEGER)"
        digits += [
            f"substr('{BASE32}', (({value} >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0)
        ]
    return " || ".join(digits)


WARC = f"""
WITH p AS (SELECT page_id, ifnull(html, '') AS body, sha1(ifnull(html, '')) AS h FROM pages),
f AS (SELECT body, min(page_id) AS first FROM p GROUP BY body)
SELECT page_id, strlen(body) AS payload_bytes, {_base32("h")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (body)
"""


CRC32 = """list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split({}, ''), lambda b: [
        CAST(ascii(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END)"""

TRIE = f"""
WITH t AS (
    SELECT conv_id, ifnull(role, '') AS role, ifnull(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, count(*) AS own, conv_id - conv_id % 5 AS base,
           xor({CRC32.format("CAST(conv_id AS VARCHAR)")}, 4294967295) % 9 AS h
    FROM t GROUP BY conv_id),
p AS (SELECT c.*, least(h, ifnull(b.own, 0)) AS taken
      FROM c LEFT JOIN (SELECT conv_id, own FROM c) b ON b.conv_id = c.base),
r AS (
    SELECT p.conv_id, t.pos, t.role, t.text FROM p JOIN t ON t.conv_id = p.base AND t.pos < p.taken
    UNION ALL
    SELECT p.conv_id, t.pos - h + taken, t.role, t.text FROM p JOIN t ON t.conv_id = p.conv_id AND t.pos >= h),
m AS (
    SELECT conv_id, pos + 1 AS depth, strlen(text) AS size,
           md5(string_agg(md5(role) || md5(text), '' ORDER BY pos)
               OVER (PARTITION BY conv_id ORDER BY pos)) AS node
    FROM r
    UNION ALL SELECT conv_id, 0, 0, '' FROM p),
n AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved
    FROM m GROUP BY node, depth),
e AS (
    SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
    FROM (SELECT conv_id, arg_max(node, depth) AS node FROM m GROUP BY conv_id) GROUP BY node),
u AS (
    SELECT n.node, a.node AS above, n.depth - a.depth AS up
    FROM n JOIN m a ON a.conv_id = n.conv_id AND a.depth <= n.depth),
k AS (SELECT above AS node, count(*) AS children FROM u WHERE up = 1 GROUP BY above),
s AS (
    SELECT u.above AS node, sum(n.saved) AS saved, count(*) FILTER (WHERE k.node IS NULL) AS leaves
    FROM u JOIN n USING (node) LEFT JOIN k ON k.node = u.node GROUP BY u.above)
SELECT n.conv_id, n.depth, b.conv_id AS parent_conv_id, n.n_convs,
       ifnull(k.children, 0) AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, ifnull(e.ends, sha256('')) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN e USING (node)
LEFT JOIN (SELECT node, above FROM u WHERE up = 1) q USING (node)
LEFT JOIN n b ON b.node = q.above
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_warc_revisits": WARC,
        "op8_repeated_phrases": PHRASES,
        "op9_ngram_jaccard": JACCARD,
        "op12_prefix_trie": TRIE,
    }
