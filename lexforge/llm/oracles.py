"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_REACH = """
    grow AS (
      SELECT node, node AS seen FROM nodes
      UNION
      SELECT g.node, e.b FROM grow g JOIN edges e ON e.a = g.seen
    ),
    comps AS (SELECT node, min(seen) AS component_id FROM grow GROUP BY node)"""

#: Every vector against every other; components by reachability.
OP2 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    good AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    unit AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM good),
    edges AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND list_inner_product(a.u, b.u) >= 0.95),
    nodes AS (SELECT vec_id AS node FROM v),{_REACH}
SELECT vec_id, (SELECT count(*) FROM edges WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN comps ON node = vec_id"""

OP5 = f"""
WITH words AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    items AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    spans AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(greatest(len(w) - 12, 1))) AS a FROM items WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, n, w[a + 1 : a + n] AS win FROM spans),
    sizes AS (SELECT DISTINCT n FROM windows),
    places AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS a FROM words, sizes WHERE len(w) >= n),
    hits AS (SELECT p.doc_id, p.a, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.win = p.w[p.a + 1 : p.a + p.n]),
    hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS k FROM hits) GROUP BY doc_id),
    hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def _found(kind: int, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: every match follows the pieces and matches before it."""
    rx = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, source, {kind} AS kind, v, a, a + length(m) AS b FROM (
      SELECT doc_id, source, ms[i] AS m, vs[i] AS v, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a FROM (
        SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
          SELECT doc_id, source, regexp_extract_all(text, '{rx}', 0) AS ms, regexp_extract_all(text, '{rx}', {group}) AS vs, string_split_regex(text, '{rx}') AS ps FROM documents)))
    WHERE length(v) >= {least}"""


_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

OP6 = f"""
WITH base AS ({_found(0, _ASSIGN, 2, 8)} UNION ALL {_found(1, "AKIA[A-Z0-9]+", 0, 16)} UNION ALL {_found(2, "[0-9a-f]+", 0, 32)}),
    long AS ({_found(3, "[A-Za-z0-9+/_=-]+", 0, 20)}),
    mixed AS (SELECT * FROM long l WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = l.doc_id AND b.a < l.b AND l.a < b.b)),
    every AS (SELECT * FROM base UNION ALL SELECT * FROM mixed),
    owners AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS n FROM every GROUP BY v),
    said AS (SELECT e.*, n, CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'owned' END || ':' || a || ':' || b AS s FROM every e JOIN owners USING (v)),
    per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
      coalesce(string_agg(s, ',' ORDER BY a, kind) FILTER (kind < 3), '') AS plain, coalesce(string_agg(s, ',' ORDER BY a, kind) FILTER (kind < 3 OR n = 1), '') AS spans,
      count(*) FILTER (n = 1) AS n_live, count(*) FILTER (n >= 3 AND kind < 3) AS n_copied FROM said GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(plain, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM documents LEFT JOIN per USING (doc_id)"""

OP8 = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, w[a + 1 : a + 5] AS s FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS a FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    hashed AS (SELECT doc_id, md5(array_to_string(s, chr(1))) AS s FROM shingles),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM hashed x JOIN hashed y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
    edges AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
    nodes AS (SELECT doc_id AS node FROM documents),{_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN comps ON node = d.doc_id LEFT JOIN sizes USING (doc_id)"""

#: Shares by whole-number division of wide integers; every pair of sources over every kept term.
OP12 = r"""
WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    said AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n_lang_term FROM said GROUP BY ALL HAVING count(DISTINCT k) >= 10),
    langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n_lang_term) AS HUGEINT) AS n_lang FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(any_value(n_lang), 0) AS n_lang, coalesce(any_value(g.n), 0) AS n_group
      FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN langs USING (lang) LEFT JOIN (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS n FROM counts GROUP BY ALL) g USING (lang, source) GROUP BY ALL),
    shares AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 2) // (n_group + 2 * v) AS p, 1 + 1000000000 * (n_lang_term + 2) // (n_lang + 2 * v) AS q
      FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    found AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

#: The lowest bits of the CRC-32 of a decimal id, bit by bit: a byte comes in, and eight shifts (-1) follow.
_CRC = """xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""

#: Every prefix as a list of turns; subtrees by comparing lists.
OP11 = f"""
WITH said AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
    convs AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM said)),
    built AS (
      SELECT c.conv_id, 0 AS half, s.pos, role, text FROM convs c JOIN said s ON s.conv_id = c.conv_id - c.conv_id % 20 AND s.pos <= h
      UNION ALL SELECT conv_id, 1, pos, role, text FROM said JOIN convs USING (conv_id) WHERE pos > h),
    whole AS (SELECT conv_id, coalesce(list(struct_pack(r := role, t := text) ORDER BY half, pos) FILTER (role IS NOT NULL), []) AS w FROM convs LEFT JOIN built USING (conv_id) GROUP BY conv_id),
    members AS (SELECT conv_id, w, d, w[1 : d] AS p FROM whole, (SELECT unnest(range((SELECT max(len(w)) + 1 FROM whole))) AS d) WHERE d <= len(w)),
    nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(w) = d), '') AS ends FROM members GROUP BY p, d),
    tree AS (SELECT n.*, (SELECT count(*) FROM nodes x WHERE x.d = n.d + 1 AND x.p[1 : n.d] = n.p) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) END AS saved FROM nodes n),
    subtrees AS (SELECT a.p, a.d, count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens FROM tree a JOIN tree b ON b.d >= a.d AND b.p[1 : a.d] = a.p GROUP BY ALL)
SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, sha256(t.ends) AS ends_sha256
FROM tree t JOIN subtrees s ON s.p = t.p LEFT JOIN nodes u ON t.d > 0 AND u.d = t.d - 1 AND u.p = t.p[1 : t.d - 1]"""
