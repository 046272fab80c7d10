"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import license_texts as L


def _texts(values) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in values)


def license_sql() -> str:
    """The licence texts are fixed values; cutting, normalising and matching are stated again. Identifiers are letters,
    so that sequences are strings and rules are patterns."""
    code = {name: chr(0x100 + i) for i, name in enumerate(dict.fromkeys(n for n, _ in L.SENTENCES))}
    known = _texts([(s, code[i]) for i, s in L.SENTENCES])
    names = _texts([(c, i) for i, c in code.items()])
    rules = [(name, "".join(code[i] for i in ids)) for name, ids in L.RULES]
    either = "|".join(seq for _, seq in rules)
    licences = _texts([(seq, name) for name, seq in rules])
    kept = ", ".join(f"'{p}'" for p in L.PERMISSIVE)
    word = "trim(regexp_replace({}, '[^a-z0-9.]+', ' ', 'g'), ' .')"
    return rf"""
WITH t0 AS (SELECT row_number() OVER () AS nr, doc_id, lower(coalesce(text, '')) AS t FROM documents),
t1 AS (SELECT nr, doc_id, regexp_replace(t, '\r\n?|[\x0b\x0c\x{{85}}\x{{2028}}\x{{2029}}\x01]', chr(10), 'g') AS t FROM t0),
t2 AS (SELECT nr, doc_id, regexp_replace(regexp_replace(t, '(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+|<!--|%+)[ \t]*', '', 'g'),
                                         '(?m)[ \t]*(?:\*+/|-->)[ \t]*$', '', 'g') AS t FROM t1),
t3 AS (SELECT nr, doc_id, regexp_replace(regexp_replace(t, '\n[ \t]*\n\s*', chr(1), 'g'),
                                         '(^|[\n\x01])[ \t]*[(]?(?:[0-9]{{1,2}}|[a-z])[.)][ \t]+', chr(1), 'g') AS t FROM t2),
t4 AS (SELECT nr, doc_id, regexp_replace(regexp_replace(t, '([:;.])[ \n]+[(]?[0-9]{{1,2}}[.)][ \t]+', '\1' || chr(1), 'g'),
                                         '([.!?])[")]*[ \t\n]+([^0-9 \t\n])', '\1' || chr(1) || '\2', 'g') AS t FROM t3),
cut AS (SELECT nr, unnest(string_split(t, chr(1))) AS s, generate_subscripts(string_split(t, chr(1)), 1) AS i FROM t4),
known AS (SELECT * FROM (VALUES {known}) k(w, c)),
whole AS (SELECT nr, i, 0 AS j, c, s FROM cut LEFT JOIN known ON {word.format("s")} = w),
line AS (SELECT nr, i, unnest(string_split(s, chr(10))) AS s, generate_subscripts(string_split(s, chr(10)), 1) AS j FROM whole WHERE c IS NULL),
ids AS (SELECT nr, i, j, c FROM whole WHERE c IS NOT NULL
        UNION ALL SELECT nr, i, j, known.c FROM line JOIN known ON {word.format("s")} = w),
seq AS (SELECT nr, string_agg(c, '' ORDER BY i, j) AS ids FROM ids GROUP BY nr),
lic AS (SELECT nr, unnest(regexp_extract_all(ids, '{either}')) AS m, generate_subscripts(regexp_extract_all(ids, '{either}'), 1) AS i FROM seq),
named AS (SELECT nr, string_agg(name, ',' ORDER BY i) AS licenses, count(*) AS n, bool_or(name NOT IN ({kept})) AS bad
          FROM lic JOIN (SELECT DISTINCT * FROM (VALUES {licences})) l(p, name) ON m = p GROUP BY nr),
parts AS (SELECT nr, 1 AS which, unnest(regexp_extract_all(ids, '.')) AS c, generate_subscripts(regexp_extract_all(ids, '.'), 1) AS i FROM seq
          UNION ALL
          SELECT nr, 2, unnest(regexp_extract_all(regexp_replace(ids, '{either}', '', 'g'), '.')),
                 generate_subscripts(regexp_extract_all(regexp_replace(ids, '{either}', '', 'g'), '.'), 1) FROM seq),
shown AS (SELECT nr, string_agg(name, ',' ORDER BY i) FILTER (which = 1) AS s, string_agg(name, ',' ORDER BY i) FILTER (which = 2) AS o
          FROM parts JOIN (VALUES {names}) x(code, name) ON c = code GROUP BY nr)
SELECT doc_id, coalesce(s, '') AS sentences, coalesce(licenses, '') AS licenses, coalesce(o, '') AS left_over,
       CAST(coalesce(n, 0) AS BIGINT) AS n_licenses, coalesce(bad, false) OR coalesce(o, '') <> '' AS restricted
FROM t0 LEFT JOIN named USING (nr) LEFT JOIN shown USING (nr)
""".replace("\\\\", "\\")


STATEMENTS: dict[str, str] = {
    "op2_substring_dedup": """
WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
    SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS h
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM dw)),
rep AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM win)
    WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS k FROM rep),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS k FROM dw),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n
         FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (doc_id)
""",
    "op3_secret_scan": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
rules(kind, rank, g, least, p) AS (VALUES
    ('assign', 0, 2, 6, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
    ('access', 1, 0, 20, 'AKIA[A-Z0-9]+'),
    ('hex', 2, 0, 24, '[0-9a-f]+')),
hits AS (
    SELECT doc_id, 'assign' AS kind, 0 AS rank, 6 AS least, regexp_extract_all(t, p, 0) AS m, regexp_extract_all(t, p, 2) AS j,
           regexp_split_to_array(t, p) AS gaps FROM d, (SELECT p FROM rules WHERE kind = 'assign')
    UNION ALL
    SELECT doc_id, 'access', 1, 20, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
           regexp_split_to_array(t, 'AKIA[A-Z0-9]+') FROM d
    UNION ALL
    SELECT doc_id, 'hex', 2, 24, regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'),
           regexp_split_to_array(t, '[0-9a-f]+') FROM d),
each AS (SELECT doc_id, kind, rank, least, m[i] AS m, j[i] AS j, gaps[i] AS gap, i
         FROM (SELECT *, unnest(generate_series(1, len(m))) AS i FROM hits)),
placed AS (
    SELECT doc_id, kind, rank, length(m) AS n, length(j) >= least AS good,
           CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM each),
spans AS (
    SELECT doc_id, string_agg(kind || ':' || (e - n) || ':' || e, ',' ORDER BY e - n, rank) AS s,
           count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h
    FROM placed WHERE good GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access,
       CAST(coalesce(h, 0) AS BIGINT) AS n_hex, sha256(coalesce(s, '')) AS base_sha256, coalesce(s, '') AS spans
FROM d LEFT JOIN spans USING (doc_id)
""",
    "op4_topk_search": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored)
SELECT * FROM ranked WHERE rank <= 5
""",
    "op7_jaccard_join": """
WITH RECURSIVE dw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM dw WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
    SELECT x, y FROM pairs JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM linked UNION SELECT y, x FROM linked),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT dw.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       least(dw.doc_id, coalesce((SELECT min(y) FROM reach WHERE x = dw.doc_id), dw.doc_id)) AS component_id
FROM dw LEFT JOIN size ON size.doc_id = dw.doc_id
""",
    "op8_license_scan": license_sql(),
    "op9_decontaminate": """
WITH dw AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
pat AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS p
    FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM bw WHERE len(w) > 0)),
starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM dw),
win AS (
    SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS p
    FROM starts, (SELECT DISTINCT m FROM pat) WHERE i + m - 1 <= len(w)),
occ AS (SELECT win.doc_id, win.i, win.m, pat.item_id FROM win JOIN pat ON win.m = pat.m AND win.p = pat.p),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS k FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS joined, list(s ORDER BY s) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op12_url_filter": """
WITH RECURSIVE rules(rule, verdict, h, p) AS (VALUES
    ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'), ('example.org/en/1', 'block', 'example.org', '/en/1'),
    ('com/fr/', 'allow', 'com', '/fr/'), ('com/de/', 'block', 'com', '/de/')),
page AS (
    SELECT row_number() OVER () AS nr, page_id, url, html,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest
    FROM pages),
tag AS (
    SELECT host, path, rest,
           unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>', ' ', 'g'), '(?is)<(?:link|meta)\\b[^>]*>')) AS t
    FROM page),
said AS (
    SELECT host, path, rest, replace(CASE
        WHEN regexp_matches(t, '(?is)^<link') AND regexp_matches(t, '(?is)\\srel\\s*=\\s*(?:"[^"]*\\bcanonical\\b[^"]*"|''[^'']*\\bcanonical\\b[^'']*''|canonical\\b)')
        THEN trim(regexp_extract(t, '(?is)\\shref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 1)
               || regexp_extract(t, '(?is)\\shref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 2)
               || regexp_extract(t, '(?is)\\shref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 3))
        WHEN regexp_matches(t, '(?is)^<meta') AND regexp_matches(t, '(?is)\\shttp-equiv\\s*=\\s*["'']?refresh\\b')
        THEN trim(regexp_extract(t, '(?is)\\scontent\\s*=\\s*(?:"[^"]*?\\burl\\s*=\\s*''?([^"'']+)|''[^'']*?\\burl\\s*=\\s*"?([^"'']+))', 1)
               || regexp_extract(t, '(?is)\\scontent\\s*=\\s*(?:"[^"]*?\\burl\\s*=\\s*''?([^"'']+)|''[^'']*?\\burl\\s*=\\s*"?([^"'']+))', 2))
        ELSE '' END, '&amp;', '&') AS link
    FROM tag),
target AS (
    SELECT host || rest AS a, host <> '' AS known, CASE
        WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
        WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') OR link = '' THEN ''
        WHEN starts_with(link, '//') THEN 'http:' || link
        WHEN host = '' OR starts_with(link, '#') THEN ''
        WHEN starts_with(link, '/') THEN 'http://' || host || link
        WHEN starts_with(link, '?') THEN 'http://' || host || path || link
        ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)?', 0) END || link END AS u
    FROM said),
edge AS (
    SELECT DISTINCT a, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                       || regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b
    FROM target WHERE known AND regexp_matches(u, '(?s)^.*?://[^/?#]+')),
both_ways AS (SELECT a, b FROM edge WHERE a <> b UNION SELECT b, a FROM edge WHERE a <> b),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
node AS (SELECT DISTINCT b AS n, regexp_extract(b, '(?s)^[^/?#]*', 0) AS host, regexp_extract(b, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM reach),
bad AS (
    SELECT n FROM (SELECT n, arg_max(r.verdict, length(r.rule)) AS v FROM node JOIN rules r
                   ON (node.host = r.h OR ends_with(node.host, '.' || r.h)) AND starts_with(node.path, r.p) GROUP BY n) WHERE v = 'block'),
passed AS (SELECT DISTINCT a FROM reach JOIN bad ON n = b),
own AS (
    SELECT nr, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
    FROM page JOIN rules r ON (page.host = r.h OR ends_with(page.host, '.' || r.h)) AND starts_with(page.path, r.p) GROUP BY nr)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN passed.a IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM page LEFT JOIN own USING (nr) LEFT JOIN passed ON page.host <> '' AND passed.a = page.host || page.rest
""",
    "op13_periodic_runs": """
WITH RECURSIVE bit(i, k, c) AS (
    SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bit WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bit WHERE k = 8),
d AS (
    SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                           lambda acc, b: xor(acc >> 8, t[1 + CAST(xor(acc, b) & 255 AS INTEGER)])), 4294967295) AS h
    FROM documents, crc),
cut AS (SELECT *, h // 10 AS g, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS hit FROM d),
cut2 AS (SELECT *, CASE WHEN hit THEN g % n END AS a FROM cut),
cut3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut2),
words AS (
    SELECT nr, n, i, CASE WHEN hit AND i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM cut3)),
pairs AS (
    SELECT x.nr, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.nr = y.nr AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
    SELECT nr, q, min(i) AS s, count(*) + q AS l
    FROM (SELECT *, i - row_number() OVER (PARTITION BY nr, q ORDER BY i) AS island FROM pairs) GROUP BY nr, q, island),
runs AS (SELECT nr, s, l, min(q) AS q FROM islands WHERE l >= greatest(6, 4 * q) GROUP BY nr, s, l),
per AS (
    SELECT nr, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
           list({'s': s, 'l': l, 'q': q} ORDER BY l DESC, s, q)[1] AS top FROM runs GROUP BY nr),
gone AS (SELECT DISTINCT nr, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT nr, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (nr, i) GROUP BY nr)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(top.l AS BIGINT) AS length,
       CAST(top.q AS BIGINT) AS period, CAST(1000 * top.l // top.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (nr) LEFT JOIN kept USING (nr)
""",
    "op11_collocations": """
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
    FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
gram AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (VALUES (1), (2), (3)) x(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS f FROM gram GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE f >= 10),
cut AS (
    SELECT lang, phrase, k, f AS a, s, c, array_to_string(s[1 : c], ' ') AS x, array_to_string(s[c + 1 : k], ' ') AS y
    FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM often WHERE k > 1)),
score AS (
    SELECT cut.lang, cut.phrase, cut.k, a, c, p.f AS l, q.f AS r,
           CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
    FROM cut JOIN f p ON p.lang = cut.lang AND p.phrase = x AND p.k = c JOIN f q ON q.lang = cut.lang AND q.phrase = y AND q.k = cut.k - c),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS nr FROM score),
inside AS (
    SELECT lang, phrase, max(f) AS f FROM (
        SELECT lang, array_to_string(s[1 : 2], ' ') AS phrase, f FROM often WHERE k = 3
        UNION ALL SELECT lang, array_to_string(s[2 : 3], ' '), f FROM often WHERE k = 3) GROUP BY lang, phrase),
kept AS (
    SELECT b.* FROM best b LEFT JOIN inside i ON b.k = 2 AND i.lang = b.lang AND i.phrase = b.phrase
    WHERE nr = 1 AND (i.f IS NULL OR 100 * i.f < 50 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
}
