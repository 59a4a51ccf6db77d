"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .license_texts import TEXTS

SQL: dict[str, str] = {}

SQL["op1_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CASE WHEN length(text) > 0
              THEN 0.25::DOUBLE + (0.75::DOUBLE * length(translate(text, '#%*$&!@^~|{}[]<>\=_+', ''))) / length(text)
              ELSE 1.0::DOUBLE END AS w,
         (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656::DOUBLE AS u
  FROM documents),
k AS (SELECT *, -ln(u) / greatest(w, 1e-9) AS key FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT source, source_size, 3 * source_size AS cap,
         list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) AS w
  FROM s0),
s2 AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
         (sum(cap) OVER r - cap)::DOUBLE AS capped,
         sum(w) OVER () - sum(w) OVER r + w AS open_w
  FROM s1 WINDOW r AS (ORDER BY cap / w, source NULLS LAST)),
lv AS (
  SELECT arg_min((total - capped) / open_w, (cap / w, source)) AS level
  FROM s2 WHERE (total - capped) / open_w <= cap / w),
t AS (SELECT source, source_size, least(coalesce(level, 1e300) * w, cap::DOUBLE) AS target FROM s2, lv),
e AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN least(3, floor(target / source_size))::BIGINT ELSE 0 END AS epochs FROM t),
r AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
         CASE WHEN e.epochs < 3 THEN e.target - e.epochs * e.source_size ELSE 0 END AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) - k.size / 2 AS middle
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

SQL["op5_chat_perspectives"] = r"""
WITH t0 AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, text FROM conversations),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text NULLS FIRST) - 1 AS place,
         place // 256 AS part
  FROM t0),
p AS (SELECT DISTINCT conv_id AS c, role AS perspective FROM t WHERE role <> 'system'),
m AS (
  SELECT t.*, p.perspective, t.role = p.perspective AS own,
         '<|im_start|>' || CASE WHEN t.role = p.perspective THEN 'assistant' WHEN t.role = 'system' THEN t.role
                                ELSE 'user name=' || t.role END || chr(10) AS head,
         replace(coalesce(t.text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS body
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.c),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (w ROWS UNBOUNDED PRECEDING) - length(body) AS b,
         sum(length(head) + length(body)) OVER (w ROWS UNBOUNDED PRECEDING) AS e
  FROM m WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY place)),
q AS (SELECT *, min(b - length(head)) OVER (PARTITION BY conv_id, perspective, part) AS s FROM o)
SELECT conv_id, perspective, part::BIGINT AS part, any_value(s)::BIGINT AS start, count(*)::BIGINT AS n_messages,
       count(*) FILTER (WHERE own)::BIGINT AS n_spans, string_agg(head || body, '' ORDER BY place) AS text,
       coalesce(string_agg((b - s)::BIGINT::VARCHAR || ':' || (e - s)::BIGINT::VARCHAR, ',' ORDER BY place) FILTER (WHERE own), '') AS mask
FROM q GROUP BY conv_id, perspective, part
"""

SQL["op9_warc_revisits"] = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, n, max(page_id) AS o FROM p WHERE n >= 1000 GROUP BY d, n)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN g.o IS NULL OR g.o = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.o <> p.page_id THEN g.o END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d AND p.n = g.n
"""

_NOTICES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("mit-notice", "released under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("all-rights-reserved", "all rights reserved"),
)
_PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))




def _values(rows) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in rows)


_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op8_license_scan"] = rf"""
WITH n0 AS (SELECT label, {_WORDS.format("x")} AS ws FROM (VALUES {_values(_NOTICES + TEXTS)}) AS v(label, x)),
n AS (
  SELECT label, ws, list_distinct(ws) AS tokens, (SELECT min(s) FROM (VALUES (32), (64), (128), (256), (512)) AS v(s) WHERE len(ws) <= s + 1) AS stride
  FROM n0),
p AS (SELECT label, {_WORDS.format("x")} AS ws FROM (VALUES {_values(_PHRASES)}) AS v(label, x)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
b AS (
  SELECT r, stride, ws[s + 1 : s + 2 * stride] AS block
  FROM (SELECT r, ws, stride, unnest(range(0, len(ws), stride)) AS s FROM d, (SELECT DISTINCT stride FROM n))),
m AS (
  SELECT b.r, n.label, len(list_intersect(list_distinct(b.block), n.tokens)) / len(n.tokens)::DOUBLE AS share,
         len(list_intersect(list_distinct(b.block), n.tokens)) >= ceil(0.8 * len(n.tokens) - 1e-9) AS ok
  FROM b JOIN n ON b.stride = n.stride),
w AS (SELECT r, ws, unnest(range(0, len(ws))) AS i FROM d),
f AS (
  SELECT w.r, p.label, w.i FROM w JOIN p ON w.ws[w.i + 1] = p.ws[1]
  WHERE w.ws[w.i + 1 : w.i + len(p.ws)] = p.ws),
fa AS (SELECT r, count(*)::BIGINT AS n_base, min(i)::BIGINT AS first_word, max(i)::BIGINT AS last_word FROM f GROUP BY r),
la AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, share, false AS base FROM m WHERE ok UNION ALL SELECT r, label, 1.0::DOUBLE, true FROM f) GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(fa.n_base, 0)::BIGINT AS n_base, fa.first_word, fa.last_word,
       coalesce(la.base_labels, '') AS base_labels, coalesce(la.labels, '') AS labels, coalesce(la.score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN fa ON d.r = fa.r LEFT JOIN la ON d.r = la.r
"""

SQL["op2_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
w AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[i : i + 9], ' ') AS t
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM b WHERE len(ws) > 0)),
g AS (
  SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS t
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w))),
h AS (SELECT g.r, g.i, w.n, w.item FROM g JOIN w ON g.n = w.n AND g.t = w.t),
hw AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
hi AS (SELECT r, count(DISTINCT item)::BIGINT AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(hw.n_hit, 0)::BIGINT AS n_hit,
       coalesce(hi.n_items, 0)::BIGINT AS n_items, sha256(coalesce(hi.items, '')) AS items_sha256,
       hw.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hw ON d.r = hw.r LEFT JOIN hi ON d.r = hi.r
"""

SQL["op3_embedding_near_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(node, root) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*)::BIGINT AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON v.vec_id = c.node LEFT JOIN n ON n.a = v.vec_id
"""

SQL["op6_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i - 1 AS line, ls[i] AS t FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
w AS (
  SELECT doc_id, line, doc_id * 1000000 + line AS place,
         regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM l),
c AS (
  SELECT array_to_string(ws, ' ') AS t, any_value(ws) AS ws, min(place) AS place
  FROM w WHERE len(ws) > 0 GROUP BY array_to_string(ws, ' ')),
v AS (
  SELECT place, len(ws) AS n, i, hash(array_to_string(list_concat(ws[1 : i - 1], ws[i + 1 :]), ' ')) AS rest
  FROM (SELECT place, ws, unnest(range(1, len(ws) + 1)) AS i FROM c WHERE len(ws) >= 5)),
o AS (SELECT place, hash(t) AS own FROM c WHERE len(ws) >= 4),
near AS (
  SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY n, i, rest) AS m FROM v) WHERE m < place
  UNION SELECT v.place FROM v JOIN o ON v.rest = o.own WHERE o.place < v.place
  UNION SELECT o.place FROM v JOIN o ON v.rest = o.own WHERE v.place < o.place),
gone AS (
  SELECT w.doc_id, w.line FROM w JOIN c ON array_to_string(w.ws, ' ') = c.t
  WHERE len(w.ws) > 0 AND (w.place <> c.place OR c.place IN (SELECT place FROM near))),
g AS (SELECT doc_id, count(*)::BIGINT AS n, string_agg(line::VARCHAR, ',' ORDER BY line) AS removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.ls), 0)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_removed, coalesce(g.removed, '') AS removed_lines
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""

#: The kinds in order, as the SQL below states them by itself: pattern, least characters, group that they are counted in.
_KINDS = (
    (
        "assign",
        r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
        r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        6,
        1,
    ),
    ("access", "AKIA[A-Z0-9]+", 20, 0),
    ("hex", "[0-9a-f]+", 24, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 1, 0),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 1, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0),
    ("pem", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 1, 0),
)


def _spans(n: int, kind: str, pattern: str, least: int, group: int) -> str:
    """Matches of a kind: what stands between them (the text split by the pattern) tells where they are."""
    whole = pattern.replace("([A-Z", "(?:[A-Z")
    return f"""
  SELECT r, {n} AS n, '{kind}' AS kind, start, stop FROM (
    SELECT r, list_sum([length(x) for x in parts[1:i]]) + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0) AS start,
           start + length(found[i]) AS stop, length(counted[i]) AS size
    FROM (SELECT r, found, counted, parts, unnest(range(1, len(found) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(text, '{whole}') AS found, regexp_extract_all(text, '{pattern}', {group}) AS counted,
             regexp_split_to_array(text, '{whole}') AS parts FROM d)))
  WHERE size >= {least}"""


SQL["op4_secret_scan"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_spans(n, *k) for n, k in enumerate(_KINDS))}),
g AS (
  SELECT r, count(*) FILTER (WHERE kind = 'assign')::BIGINT AS n_assign, count(*) FILTER (WHERE kind = 'access')::BIGINT AS n_access,
         count(*) FILTER (WHERE kind = 'hex')::BIGINT AS n_hex,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, n) FILTER (WHERE n < 3) AS base,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, n) AS spans
  FROM f GROUP BY r)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.r = g.r
"""
