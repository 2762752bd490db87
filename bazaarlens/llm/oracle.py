"""SQL of the queries that SQL can express, for DuckDB over the test tables."""

from __future__ import annotations

_LINES = r"""
lines AS (
  SELECT doc_id, p, l,
    translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS p
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
shared AS (
  SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.p, l.l, s.k IS NOT NULL AND l.doc_id < s.last AS gone
  FROM lines l LEFT JOIN shared s ON l.k = s.k AND length(l.k) >= 40)
"""

LINE_DEDUP = f"""
WITH {_LINES}
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, w[i : i + least(10, len(w)) - 1] AS win, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.i, p.n, x.item FROM places p JOIN windows x ON p.win = x.win),
hit AS (
  SELECT doc_id, count(DISTINCT j)::BIGINT AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.s, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

URL_FILTER = """
WITH cut AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parts AS (
  SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rules(h, p, v) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT page_id, max_by({'rule': h || p, 'verdict': v}, length(h || p)) AS best
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT c.page_id, coalesce(c.host, '') AS host, coalesce(c.path, '') AS path, f.best.rule AS rule,
  coalesce(f.best.verdict, 'allow') AS verdict
FROM parts c LEFT JOIN fit f USING (page_id)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(1, len(w) - 3) + 1),
    lambda k: array_to_string(w[k : k + 3], ' ')))) AS s
  FROM doc WHERE len(w) > 0),
one AS (SELECT min(doc_id) AS a, s, len(s) AS n FROM sets GROUP BY s),
item AS (SELECT a, n, unnest(s) AS x FROM one),
link AS (
  SELECT p.a AS a, q.a AS b FROM item p JOIN item q ON p.x = q.x AND p.a <> q.a
    AND 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
  GROUP BY p.a, q.a, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach AS (SELECT a, a AS b FROM one UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
component AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(o.n, 0)::BIGINT AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM doc d LEFT JOIN sets s ON s.doc_id = d.doc_id LEFT JOIN one o ON o.s = s.s LEFT JOIN component c ON c.a = o.a
"""

#: CRC-32 of a decimal number, byte by byte and bit by bit.
_CRC = """
xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
  flatten(list_transform(range(1, length(c::VARCHAR) + 1), lambda k:
    list_concat([ascii(substr(c::VARCHAR, k, 1))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
  lambda s, v: CASE WHEN v >= 0 THEN xor(s, v) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END))
"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT k.c, 0 AS part, t.p, t.r, t.x FROM convs k JOIN turns t ON t.c = k.c - k.c % 5 AND t.p <= k.h
  UNION ALL SELECT t.c, 1, t.p, t.r, t.x FROM turns t JOIN convs k ON t.c = k.c AND t.p > k.h),
steps AS (
  SELECT c, row_number() OVER w AS d, strlen(x) AS b,
    string_agg(length(r) || ':' || length(x) || ':' || r || x, '') OVER w AS k
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, p)
  UNION ALL SELECT c, 0, 0, '' FROM convs),
ends AS (SELECT c, max(d) AS turns FROM steps GROUP BY c),
nodes AS (
  SELECT s.k, s.d, min(s.c) AS c, max(s.b) AS b, count(*) AS n,
    sha256(coalesce(string_agg(s.c::VARCHAR, ',' ORDER BY s.c) FILTER (WHERE s.d = e.turns), '')) AS ends_sha256
  FROM steps s JOIN ends e USING (c) GROUP BY s.k, s.d),
linked AS (
  SELECT n.*, u.k AS parent, pn.c AS parent_conv_id
  FROM nodes n LEFT JOIN steps u ON u.c = n.c AND u.d = n.d - 1 LEFT JOIN nodes pn ON pn.k = u.k),
children AS (SELECT parent AS k, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
totals AS (
  SELECT s.k, count(*) FILTER (WHERE h.n_children IS NULL) AS n_leaves, sum((n.n - 1) * n.b) AS saved_tokens
  FROM nodes n LEFT JOIN children h ON h.k = n.k JOIN steps s ON s.c = n.c AND s.d <= n.d GROUP BY s.k)
SELECT l.c AS conv_id, l.d::BIGINT AS depth, l.parent_conv_id, l.n::BIGINT AS n_convs,
  coalesce(h.n_children, 0)::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves,
  t.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN totals t ON t.k = l.k LEFT JOIN children h ON h.k = l.k
"""

ORACLE = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_decontamination": DECONTAMINATION,
    "op8_url_filter": URL_FILTER,
    "op11_ngram_join": NGRAM_JOIN,
    "op13_prefix_trie": PREFIX_TRIE,
}
