"""DuckDB SQL for the queries that SQL can express, each written from the query's definition."""

from __future__ import annotations

_LOWER = "translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"

OP4 = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_SPACED.format(c="text")} AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], chr(10)))
      WHEN len(words) > 0 THEN ['short' || chr(10) || len(words) || chr(10) || array_to_string(words, chr(10))]
      ELSE [] END) AS shingle FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
  WHERE 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, upper(sha1(body)) AS digest, min(page_id) OVER (PARTITION BY body) AS first FROM p),
b AS (
  SELECT page_id, payload_bytes, first, array_to_string(list_transform(list_transform(range(0, 8), lambda i: CAST('0x' || substr(digest, 5 * i + 1, 5) AS BIGINT)), lambda v:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10) % 32 + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1)), '') AS payload_digest
  FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

OP7 = f"""
WITH w AS MATERIALIZED (SELECT doc_id, {_ALNUM.format(c="text")} AS words FROM documents),
i AS MATERIALIZED (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ALNUM.format(c="text")} AS words FROM benchmark),
size AS (SELECT item_id, words, least(13, len(words)) AS k FROM i WHERE len(words) > 0),
gram AS (SELECT DISTINCT item_id, k, gram FROM (
  SELECT item_id, k, unnest(list_transform(range(1, len(words) - k + 2), lambda a: array_to_string(words[a:a + k - 1], ' '))) AS gram FROM size)),
place AS (
  SELECT doc_id, k, unnest(range(1, len(words) - k + 2)) AS pos, unnest(list_transform(range(1, len(words) - k + 2), lambda a: array_to_string(words[a:a + k - 1], ' '))) AS gram
  FROM w, (SELECT DISTINCT k FROM size) z WHERE len(words) >= k),
hit AS MATERIALIZED (SELECT p.doc_id, p.pos, p.k, g.item_id FROM place p JOIN gram g ON g.k = p.k AND g.gram = p.gram),
n AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS word FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT w.doc_id, len(w.words) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
  coalesce(n.n_hit, 0) > 0 AND 20 * coalesce(n.n_hit, 0) >= len(w.words) AS contaminated
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (
  SELECT *, 13 + length(text) + length(regexp_replace(text, '[^\\<]', '', 'gs')) + length(role) + length(regexp_replace(role, '[^\\<|]', '', 'gs')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

# CRC-32 of the decimal id, bit by bit.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))"""

OP11 = f"""
WITH t AS MATERIALIZED (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn, strlen(coalesce(text, '')) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 5 AS base, xor({_CRC}, 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.turn, t.bytes FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.turn, t.bytes FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(turn, '') OVER w AS node, coalesce(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent, bytes
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c),
n AS MATERIALIZED (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY node),
e AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM p GROUP BY conv_id) GROUP BY node),
k AS MATERIALIZED (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
s AS (
  SELECT a.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved
  FROM n a JOIN n b ON b.depth >= a.depth AND starts_with(b.node, a.node) LEFT JOIN k ON k.node = b.node GROUP BY a.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN n u ON u.node = n.parent LEFT JOIN k ON k.node = n.node LEFT JOIN e ON e.node = n.node
"""

OP12 = f"""
WITH w AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, {_ALNUM.format(c="text")} AS words FROM documents),
z AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(len(words)) AS BIGINT) AS terms FROM w WHERE len(words) > 0),
f AS MATERIALIZED (SELECT d, doc_id, len(words) AS n, term, count(*) AS tf FROM (SELECT d, doc_id, words, unnest(words) AS term FROM w) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, text, unnest({_ALNUM.format(c="text")}) AS term FROM benchmark),
df AS MATERIALIZED (SELECT term, count(*) AS df, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, z WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
g AS MATERIALIZED (SELECT d, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS part FROM f JOIN df USING (term), z),
s AS (SELECT item_id, text, d, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN g USING (term) GROUP BY item_id, text, d, doc_id HAVING sum(part) > 0),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s)
SELECT * FROM r WHERE rank <= 50
"""

ORACLES: dict[str, str] = {
    "op4_ngram_jaccard_rtree": OP4,
    "op5_warc_revisit_resolution": OP5,
    "op7_decontamination_suffix_arrays": OP7,
    "op8_chat_prefix_targets": OP8,
    "op10_cover_tree_top_k": OP10,
    "op11_prefix_trie_collapse": OP11,
    "op12_pair_bound_maxscore": OP12,
}
