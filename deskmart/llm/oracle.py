"""SQL counterparts of the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

# Words: ASCII letters and digits and all other characters, A-Z lower-cased.
_WORDS = r"""
  list_filter(
    string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '')
"""

OP5 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n FROM pages
), g AS (
  SELECT html, max(page_id) AS best FROM p WHERE n >= 1000 GROUP BY html HAVING count(*) > 1
)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN g.best IS NOT NULL AND p.page_id IS DISTINCT FROM g.best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM g.best THEN g.best END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html AND p.n >= 1000
"""

OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS span
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM spans),
firsts AS (SELECT DISTINCT n, span[1] AS f FROM spans),
places AS (
  SELECT doc_id, w, i, w[i] AS f FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
),
hits AS (
  SELECT p.doc_id, p.i, s.n, s.item_id
  FROM (SELECT p.doc_id, p.i, k.n, list_slice(p.w, p.i, p.i + k.n - 1) AS span
        FROM places p JOIN firsts k ON p.f = k.f AND p.i + k.n - 1 <= len(p.w)) p
  JOIN spans s ON s.n = p.n AND s.span = p.span
),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# crc32 bit by bit over the decimal digits; a prefix is known by the digest of the digests of its turns.
OP13 = """
WITH t AS (
  SELECT conv_id, code, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) AS place
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS n,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code
        FROM conversations WHERE conv_id IS NOT NULL)
),
ids AS (
  SELECT conv_id,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, c: list_reduce(
             list_prepend(xor(a, c), range(8)),
             lambda b, i: xor(b >> 1, CASE WHEN b % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
),
turns AS (
  SELECT i.conv_id, 0 AS own, place, code, n FROM ids i JOIN t ON t.conv_id = i.conv_id - i.conv_id % 100 AND place <= h
  UNION ALL
  SELECT conv_id, 1, place, code, n FROM ids JOIN t USING (conv_id) WHERE place > h
),
seqs AS (
  SELECT conv_id, coalesce(list(code ORDER BY own, place) FILTER (WHERE code IS NOT NULL), []) AS codes,
         coalesce(list(n ORDER BY own, place) FILTER (WHERE code IS NOT NULL), []) AS ns
  FROM ids LEFT JOIN turns USING (conv_id) GROUP BY conv_id
),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(codes) AS codes,
         any_value(CASE WHEN depth > 0 THEN ns[depth] ELSE 0 END) AS n,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(codes) = depth), '')) AS ends_sha256
  FROM (SELECT conv_id, depth, codes, ns, sha256(coalesce(array_to_string(codes[1:depth], ''), '')) AS key,
               sha256(coalesce(array_to_string(codes[1:depth - 1], ''), '')) AS up
        FROM (SELECT *, unnest(range(0, len(codes) + 1)) AS depth FROM seqs))
  GROUP BY key, depth
),
children AS (SELECT up AS key, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (key, depth)),
subtrees AS (
  SELECT sha256(coalesce(array_to_string(codes[1:over], ''), '')) AS key, over AS depth,
         count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * n) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS over FROM counted)
  GROUP BY ALL
)
SELECT c.conv_id::BIGINT AS conv_id, c.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
       c.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees USING (key, depth) LEFT JOIN counted p ON p.key = c.up AND p.depth = c.depth - 1
"""

ORACLE_SQL = {"op13_prefix_trie": OP13, "op5_warc_salvage": OP5, "op7_winnowing_decontamination": OP7}
