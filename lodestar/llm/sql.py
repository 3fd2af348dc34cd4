"""DuckDB twins of the queries that SQL can express."""

QUALITY_RULES = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, r.i AS i, array_to_string(w[r.i : r.i + 7], ' ') AS s FROM d, unnest(range(1, len(w) - 6)) AS r(i)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) WHERE c > 1
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(8) AS x(k) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(ln.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN cov USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), h AS (
  SELECT source, count(*) AS n, sum((base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT) AS f
  FROM b GROUP BY source
), p AS (
  SELECT sum(f) / sum(n) AS m, var_pop(f / n) AS v FROM h
), k AS (
  SELECT h.source, CASE WHEN v > 0 THEN (f + m * greatest(1.0, m * (1 - m) / v - 1)) / (n + greatest(1.0, m * (1 - m) / v - 1)) ELSE m END <= m + 3.0 * sqrt(v) AS ok
  FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed) AND ok AS kept
FROM b JOIN k ON b.source IS NOT DISTINCT FROM k.source
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, r.i AS i, md5(array_to_string(w[r.i : r.i + 34], ' ')) AS s FROM d, unnest(range(1, len(w) - 33)) AS r(i)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM g) WHERE c > 1
), cov AS (
  SELECT DISTINCT doc_id, i + k AS i FROM rep, range(35) AS x(k)
), word AS (
  SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(v, ' ' ORDER BY i) AS t
  FROM word ANTI JOIN cov USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

NGRAM_JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[r.i : r.i + 4], ' ')) AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), reach(x, y) AS (
  SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) m ON m.x = d.doc_id
"""

SUFFIX_DEDUP = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, r.p AS p, md5(substr(h, 2 * r.p + 1, 100)) AS s FROM d, unnest(range(0, length(h) // 2 - 49)) AS r(p)
), rep AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS low FROM w) WHERE low < doc_id
), edge AS (
  SELECT doc_id, p, CASE WHEN p > 50 + lag(p) OVER o THEN 1 WHEN lag(p) OVER o IS NULL THEN 1 ELSE 0 END AS fresh FROM rep WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), run AS (
  SELECT doc_id, g, min(p) AS a, max(p) + 50 AS b FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM edge) GROUP BY doc_id, g
), gap AS (
  SELECT doc_id, a AS till, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM run
  UNION ALL SELECT d.doc_id, length(h) // 2, coalesce(max(b), 0) FROM d LEFT JOIN run USING (doc_id) GROUP BY d.doc_id, h
), kept AS (
  SELECT gap.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (till - since)), '' ORDER BY since) AS t FROM gap JOIN d USING (doc_id) GROUP BY gap.doc_id
), n AS (
  SELECT doc_id, count(*) AS c, sum(b - a) AS r FROM run GROUP BY doc_id
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(c, 0)::BIGINT AS n_spans, sha256(unhex(t)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

URL_FILTER = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), f AS (
  SELECT *, host || regexp_replace(path, '/+$', '') AS form FROM p
), l AS (
  SELECT DISTINCT form FROM f WHERE list_has_any(string_split(host, '.'), ['spam-farm', 'casino-win', 'adult-x', 'free-bets'])
), rules(act, h, pre) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), m AS (
  SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(act, length(h || pre)) AS act
  FROM f JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id
)
SELECT f.page_id, host, path, m.rule, coalesce(m.act, CASE WHEN l.form IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.form IS NOT NULL AS listed
FROM f LEFT JOIN m USING (page_id) LEFT JOIN l USING (form)
"""

DECONTAMINATE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[r.i : r.i + 9], ' ') AS s FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS r(i) WHERE len(w) > 0
), size AS (
  SELECT DISTINCT n FROM win
), g AS (
  SELECT doc_id, r.i AS i, n, array_to_string(w[r.i : r.i + n - 1], ' ') AS s FROM d, size, unnest(range(1, len(w) - n + 2)) AS r(i)
), hit AS (
  SELECT doc_id, i, g.n AS n, item_id FROM g JOIN win USING (n, s)
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM hit, range(10) AS x(k) WHERE k < hit.n GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS t FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(it.t, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT rid, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
), v AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), own AS (
  SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(own.n, 0) + v.v))::HUGEINT AS p,
    (1 + (1000000000::HUGEINT * (kept.n + 1)) // (v.n + v.v))::HUGEINT AS q
  FROM g JOIN v ON v.lang = g.lang JOIN kept ON kept.lang = g.lang
  LEFT JOIN own ON own.lang = g.lang AND own.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM part)
WHERE part = 'pair' OR rank <= 200
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), f1 AS (
  SELECT lang, w, count(*) AS a FROM (SELECT lang, unnest(w) AS w FROM p) GROUP BY lang, w
), n AS (
  SELECT lang, sum(a) AS n FROM f1 GROUP BY lang
), f2 AS (
  SELECT lang, w[r.i] AS w1, w[r.i + 1] AS w2, count(*) AS a FROM p, unnest(range(1, len(w))) AS r(i) GROUP BY lang, w1, w2 HAVING count(*) >= 10
), f3 AS (
  SELECT lang, w[r.i] AS w1, w[r.i + 1] AS w2, w[r.i + 2] AS w3, count(*) AS a FROM p, unnest(range(1, len(w) - 1)) AS r(i)
  GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10
), long AS (
  SELECT lang, w1, w2, max(a) AS m FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY lang, w1, w2
), c AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.a, x.a AS l, y.a AS r, (1000000::HUGEINT * f2.a * f2.a) // (x.a::HUGEINT * y.a) AS score
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w = f2.w2
  LEFT JOIN long ON long.lang = f2.lang AND long.w1 = f2.w1 AND long.w2 = f2.w2
  WHERE m IS NULL OR 100 * m < 50 * f2.a
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM (
    SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.a, x.a AS l1, yz.a AS r1, xy.a AS l2, z.a AS r2,
      (1000000::HUGEINT * f3.a * f3.a) // (x.a::HUGEINT * yz.a) AS s1, (1000000::HUGEINT * f3.a * f3.a) // (xy.a::HUGEINT * z.a) AS s2
    FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w = f3.w1 JOIN f1 z ON z.lang = f3.lang AND z.w = f3.w3
    JOIN f2 xy ON xy.lang = f3.lang AND xy.w1 = f3.w1 AND xy.w2 = f3.w2 JOIN f2 yz ON yz.lang = f3.lang AND yz.w1 = f3.w2 AND yz.w2 = f3.w3
  )
), k AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM k JOIN n USING (lang) WHERE rank <= 2000
"""

_NAMED = r"""["'']?\x20*[:=]\x20*["'']?([a-z0-9+/_.=-]+)"""
#: kind -> (text, pattern, the group whose length counts, least length)
_PARTS = {
    "assign": ("low", "(password|passwd|secret|token|api_?key)" + _NAMED, 2, 6),
    "access": ("t", "AKIA[A-Z0-9]+", 0, 20),
    "hex": ("t", "[0-9a-f]{24,}", 0, 24),
    "ident": ("low", "(access_?key_?id|client_?id|user_?name|account_?id|login)" + _NAMED, 2, 4),
    "key": ("t", "[A-Za-z0-9+/_=-]{20,}", 0, 20),
    "endpoint": ("low", r"""[a-z][a-z0-9+.-]*://[^\x00-\x20"''<>\\^`{|}\x7F]+""", 0, 0),
}
_FOUND = "\n  UNION ALL ".join(
    f"SELECT rid, '{kind}' AS kind, {k} AS k, {least} AS least, regexp_extract_all({t}, '{pattern}') AS m, regexp_extract_all({t}, '{pattern}', {group}) AS v, "
    f"regexp_split_to_array({t}, '{pattern}') AS s FROM d"
    for k, (kind, (t, pattern, group, least)) in enumerate(_PARTS.items())
)
SECRET_SCAN = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_LOWER} AS low FROM documents
), m AS (
  {_FOUND}
), i AS (
  SELECT rid, kind, k, least, unnest(m) AS x, unnest(v) AS v, unnest(s[1 : len(m)]) AS s, generate_subscripts(m, 1) AS i FROM m WHERE len(m) > 0
), span AS (
  SELECT rid, kind, k, least, v, x, (sum(length(s)) OVER w + sum(length(x)) OVER w)::BIGINT AS b FROM i WINDOW w AS (PARTITION BY rid, kind ORDER BY i)
), part AS (
  SELECT rid, kind, k, x, b - length(x) AS a, b FROM span WHERE length(v) >= least
), free AS (
  SELECT * FROM part p WHERE kind <> 'key' OR (regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[a-z]') AND regexp_matches(x, '[0-9]')
    AND NOT EXISTS (SELECT 1 FROM part o WHERE o.rid = p.rid AND o.kind IN ('assign', 'access', 'hex', 'endpoint') AND o.a < p.b AND o.b > p.a))
), scoped AS (
  SELECT f.*, len(string_split(substr(t, 1, a), chr(10) || chr(10))) AS scope FROM free f JOIN d USING (rid)
), meet AS (
  SELECT p.rid, p.kind, p.k, p.a, p.b, bool_or(o.kind IN ('access', 'ident')) AS ident, bool_or(o.kind IN ('assign', 'hex', 'key')) AS secret
  FROM scoped p JOIN scoped o ON o.rid = p.rid AND o.scope = p.scope AND o.kind <> p.kind AND o.a <= p.b + 200 AND o.b >= p.a - 200
  WHERE p.k >= 3 GROUP BY p.rid, p.kind, p.k, p.a, p.b
), found AS (
  SELECT rid, kind, k, a, b FROM part WHERE k < 3
  UNION ALL
  SELECT rid, kind, k, a, b FROM meet WHERE (kind = 'ident' AND secret) OR (kind = 'key' AND ident) OR (kind = 'endpoint' AND ident AND secret)
)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) FILTER (k < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k), '') AS spans
FROM d LEFT JOIN found USING (rid) GROUP BY rid, doc_id
"""
