"""DuckDB SQL of the operator queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op4_decontamination"] = r"""
WITH it AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM it WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM grams),
spots AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
hit AS (
  SELECT s.r, s.i, s.n, g.item_id FROM (SELECT r, i, n, list_slice(w, i, i + n - 1) AS g FROM spots) s JOIN grams g ON g.g = s.g AND g.n = s.n),
pos AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN pos USING (r) LEFT JOIN items USING (r)
"""

ORACLE_SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE sums AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 1, 1, 1, 1, 1, 1, 1, 1], lambda c, one: xor(c >> 1, 3988292384 * (c & one)))), 4294967295) AS crc
  FROM documents),
parts AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, crc % 3 = 0 AS touched,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text
  FROM sums),
leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || CASE WHEN touched THEN coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS seen
  FROM parts),
base AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes(tree, lvl, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM base
  UNION ALL
  SELECT tree, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 8, n),
subs AS (SELECT tree, h AS subroot, lvl AS depth, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, idx, n, h) AS (
  SELECT 0, idx, n, subroot FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 8, n),
below AS (
  SELECT a.tree, a.lvl, a.idx, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx) AS l, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx) AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY ALL),
beside AS (
  SELECT a.lvl, a.idx, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx) AS l, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx) AS r
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY ALL),
steps AS (
  SELECT tree, CAST(NULL AS VARCHAR) AS of_tree, lvl, idx, l, r FROM below
  UNION ALL
  SELECT CAST(NULL AS VARCHAR), s.tree, s.depth + t.lvl, t.idx, t.l, t.r FROM subs s JOIN beside t ON t.idx = s.idx // CAST(8 ** t.lvl AS BIGINT)),
walk(tree, start, lvl, h, seen, proof) AS (
  SELECT tree, idx, 0, leaf, seen, '' FROM base
  UNION ALL
  SELECT w.tree, w.start, w.lvl + 1, w.h, sha256(coalesce(s.l, '') || w.seen || coalesce(s.r, '')), w.proof || coalesce(s.l, '') || coalesce(s.r, '')
  FROM walk w JOIN steps s ON s.lvl = w.lvl AND (s.tree = w.tree AND s.idx = w.start // CAST(8 ** w.lvl AS BIGINT) OR s.of_tree = w.tree)),
done AS (SELECT tree, start, arg_max(seen, lvl) AS folded_root, arg_max(proof, lvl) AS proof FROM walk GROUP BY ALL)
SELECT b.doc_id, b.leaf, s.subroot, r.h AS root, sha256(d.proof) AS proof_sha256, d.folded_root, d.folded_root = r.h AS verified
FROM base b JOIN subs s USING (tree) JOIN done d ON d.tree = b.tree AND d.start = b.idx CROSS JOIN (SELECT h FROM tops WHERE n = 1) r
"""
