"""SQL counterparts of the operators that SQL can express, for comparison in DuckDB."""

from __future__ import annotations

#: Rules, edges from HTML, and reachability over them in either direction.
URL_FILTER = r"""
WITH RECURSIVE rules(action, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
tags AS (
  SELECT url, row_number() OVER () AS page, regexp_extract_all(
    regexp_replace(html, '(?s)<!--.*?(-->|\z)', '', 'g'), '(?is)<(?:link|meta|base)\b[^>]*>') AS tags
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL
),
named AS (
  SELECT url, page, tag, nth, regexp_matches(tag, '(?i)^<base\b') AS is_base,
    regexp_matches(tag, '(?is)^<link\b.*[\s"'']rel\s*=\s*["'']?[^"''>]*\bcanonical\b') AS canonical,
    regexp_matches(tag, '(?is)^<meta\b.*[\s"'']http-equiv\s*=\s*["'']?\s*refresh\b') AS refresh
  FROM (SELECT url, page, unnest(tags) AS tag, generate_subscripts(tags, 1) AS nth FROM tags)
),
given AS (
  SELECT url, page, nth, is_base, canonical, v.a || v.b || v.c AS given
  FROM (SELECT *, CASE WHEN is_base OR canonical
    THEN regexp_extract(tag, '(?is)[\s"'']href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', ['a', 'b', 'c'])
    ELSE regexp_extract(tag, '(?is)[\s"'']content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', ['a', 'b', 'c'])
    END AS v FROM named WHERE is_base OR canonical OR refresh)
),
decoded AS (
  SELECT * REPLACE (array_to_string(list_transform(
    regexp_extract_all(given, '&#[xX][0-9a-fA-F]{1,6};?|&#[0-9]{1,7};?|&[A-Za-z]+;|[^&]+|&'),
    lambda p: CASE
      WHEN regexp_matches(p, '^&#[xX]') THEN
        list_extract([chr(CASE WHEN n BETWEEN 1 AND 55295 OR n BETWEEN 57344 AND 1114111 THEN n ELSE 65533 END)
          FOR n IN [('0x' || rtrim(p[4:], ';'))::INT]], 1)
      WHEN regexp_matches(p, '^&#[0-9]') THEN
        list_extract([chr(CASE WHEN n BETWEEN 1 AND 55295 OR n BETWEEN 57344 AND 1114111 THEN n ELSE 65533 END)
          FOR n IN [rtrim(p[3:], ';')::INT]], 1)
      ELSE CASE lower(p) WHEN '&amp;' THEN '&' WHEN '&lt;' THEN '<' WHEN '&gt;' THEN '>' WHEN '&quot;' THEN '"'
        WHEN '&apos;' THEN '''' WHEN '&sol;' THEN '/' WHEN '&colon;' THEN ':' WHEN '&period;' THEN '.' ELSE p END
    END), '') AS given)
  FROM given
),
bases AS (
  SELECT url, page, arg_min(trim(given), nth) AS link FROM decoded WHERE is_base AND given <> '' GROUP BY ALL
),
based AS (
  SELECT page, CASE
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(url, '^([^:/?#]*)://', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '^[^:/?#]*://[^/?#]*') || link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN regexp_matches(link, '^[?#]') THEN regexp_extract(url, '^[^?#]*') || link
    WHEN regexp_matches(url, '^[^:/?#]*://[^/?#]*/') THEN regexp_extract(url, '^[^:/?#]*://[^/?#]*[^?#]*/') || link
    ELSE regexp_extract(url, '^[^:/?#]*://[^/?#]*') || '/' || link END AS base
  FROM bases
),
links AS (
  SELECT url, base, coalesce(base, url) AS under, trim(CASE WHEN canonical THEN given
    ELSE regexp_extract(given, '(?is)url\s*=\s*[''"]?([^''"]*)', 1) END) AS link
  FROM decoded LEFT JOIN based USING (page) WHERE NOT is_base
),
absolute AS (
  SELECT url, CASE
    WHEN link = '' OR base IS NULL AND regexp_matches(link, '^[?#]') THEN NULL
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(under, '^([^:/?#]*)://', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(under, '^[^:/?#]*://[^/?#]*') || link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN regexp_matches(link, '^[?#]') THEN regexp_extract(under, '^[^?#]*') || link
    WHEN regexp_matches(under, '^[^:/?#]*://[^/?#]*/') THEN regexp_extract(under, '^[^:/?#]*://[^/?#]*[^?#]*/') || link
    ELSE regexp_extract(under, '^[^:/?#]*://[^/?#]*') || '/' || link END AS target
  FROM links
),
-- Dot segments go one after another: first single dots and leading pairs, then each pair with what it follows.
undotted(url, origin, path) AS (
  SELECT url, regexp_extract(target, '^[^:/?#]*://[^/?#]*'),
    regexp_replace(regexp_replace(regexp_extract(target, '^[^:/?#]*://[^/?#]*([^?#]*)', 1),
      '(/\.)+(/|$)', '/', 'g'), '^(/\.\.)+(/|$)', '/')
  FROM absolute WHERE target IS NOT NULL
  UNION
  SELECT url, origin, regexp_replace(regexp_replace(path, '/[^/]*/\.\.(/|$)', '/'), '^(/\.\.)+(/|$)', '/')
  FROM undotted WHERE regexp_matches(path, '/\.\.(/|$)')
),
resolved AS (
  SELECT DISTINCT url AS source, origin || path AS target FROM undotted WHERE NOT regexp_matches(path, '/\.\.(/|$)')
),
urls AS (
  SELECT url FROM pages UNION SELECT source FROM resolved UNION SELECT target FROM resolved
),
parts AS (
  SELECT url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM urls WHERE url IS NOT NULL
),
split AS (
  SELECT url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
),
fits AS (
  SELECT url, rule_host || rule_path AS rule, action,
    row_number() OVER (PARTITION BY url ORDER BY length(rule_host || rule_path) DESC, action) AS nth
  FROM split JOIN rules ON host <> '' AND (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
),
judged AS (
  SELECT split.url, host, path, host || path AS node, rule, action
  FROM split LEFT JOIN (SELECT * FROM fits WHERE nth = 1) f ON f.url = split.url
),
edges AS (
  SELECT s.node AS a, t.node AS b FROM resolved r JOIN judged s ON s.url = r.source JOIN judged t ON t.url = r.target
  WHERE s.node <> '' AND t.node <> '' AND s.node <> t.node
),
ends AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, other) AS (
  SELECT a, b FROM ends UNION SELECT reach.node, ends.b FROM reach JOIN ends ON ends.a = reach.other
),
inherited AS (
  SELECT reach.node, bool_or(action = 'allow') AS allowed, bool_or(action = 'block') AS blocked
  FROM reach JOIN (SELECT DISTINCT node, action FROM judged WHERE action IS NOT NULL) j ON j.node = reach.other
  GROUP BY reach.node
)
SELECT page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule,
  coalesce(j.action, CASE WHEN i.allowed THEN 'allow' WHEN i.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN judged j ON j.url = pages.url LEFT JOIN inherited i ON i.node = j.node
"""

# The assignment pattern once more; quotes are doubled for SQL. Both cases are spelled out, since DuckDB's
# case-insensitive patterns also take letters outside of A-Z for s and k.
_WORDS = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN = (
    f"({_WORDS})"
    """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_CHARACTERS = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _places(kind: str, rank: int, pattern: str, group: int, least: int, source: str = "docs") -> str:
    """Every match with its place: the lengths of what lies before it."""
    return f"""
SELECT id, {rank} AS rank, '{kind}' AS kind, value, start_, start_ + length(found) AS end_
FROM (
  SELECT id, f[i] AS found, v[i] AS value,
    list_sum(list_transform(g[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS start_
  FROM (
    SELECT id, string_split_regex(text, '{pattern}') AS g,
      regexp_extract_all(text, '{pattern}', 0) AS f, regexp_extract_all(text, '{pattern}', {group}) AS v
    FROM {source} WHERE regexp_matches(text, '{pattern}')
  ), LATERAL (SELECT unnest(generate_series(1, len(f))) AS i)
)
WHERE length(value) >= {least}"""


def _steps(tokens: str) -> str:
    """(token's columns, previous, next): places of neighbouring characters in the alphabet."""
    return f"""
SELECT * EXCLUDE (token, c), c[i] AS next, CASE WHEN i = 1 THEN 0 ELSE c[i - 1] END AS previous
FROM (
  SELECT *, list_transform(string_split(lower(token), ''), lambda x: instr('{_CHARACTERS}', x)) AS c
  FROM ({tokens})
), LATERAL (SELECT unnest(generate_series(1, len(c))) AS i)"""


#: Learns from every document, as the query does up to its bound of 20,000 documents.
SECRETS = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
),
base AS MATERIALIZED (
  {_places("assign", 0, _ASSIGN, 2, 12)}
  UNION ALL {_places("access", 1, "AKIA[A-Z0-9]+", 0, 18)}
  UNION ALL {_places("hex", 2, "[0-9a-f]+", 0, 16)}
),
rest AS (
  SELECT regexp_replace(regexp_replace(regexp_replace(text, '{_ASSIGN}', ' ', 'g'),
    'AKIA[A-Z0-9]{{14,}}', ' ', 'g'), '[0-9a-f]{{16,}}', ' ', 'g') AS text FROM docs
),
samples AS (
  SELECT value AS token, true AS random FROM base
  UNION ALL
  SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9+/_=-]{{6,}}', 0)), false FROM rest
),
pairs AS MATERIALIZED (
  SELECT random, previous, next, count(*) AS n FROM ({_steps("SELECT token, random FROM samples")}) GROUP BY ALL
),
totals AS (SELECT random, previous, sum(n) AS n FROM pairs GROUP BY ALL),
places AS (
  SELECT place, CASE WHEN place = 0 THEN 'start' WHEN place <= 26 THEN 'letter' WHEN place <= 36 THEN 'digit' ELSE 'join' END AS class,
    CASE WHEN place <= 26 THEN 26 WHEN place <= 36 THEN 10 ELSE 5 END AS members
  FROM (SELECT unnest(generate_series(0, {len(_CHARACTERS)})) AS place)
),
shapes(class, following, share) AS (
  VALUES ('start', 'letter', 0.5::DOUBLE), ('start', 'digit', 0.5), ('letter', 'letter', 0.5), ('letter', 'join', 0.5),
    ('digit', 'digit', 0.7), ('digit', 'join', 0.3), ('join', 'letter', 0.5), ('join', 'digit', 0.4), ('join', 'join', 0.1)
),
counted AS (
  SELECT p.place AS previous, q.place AS next,
    (coalesce(a.n, 0) + 0.5::DOUBLE) / (coalesce(s.n, 0) + 0.5::DOUBLE * {len(_CHARACTERS) + 1}) AS random,
    (coalesce(b.n, 0) + 0.5::DOUBLE) / (coalesce(t.n, 0) + 0.5::DOUBLE * {len(_CHARACTERS) + 1}) AS ordinary,
    CASE WHEN q.place > 0 THEN coalesce(f.share, 0) / q.members ELSE 0 END AS shaped
  FROM places p CROSS JOIN places q
  LEFT JOIN pairs a ON a.random AND a.previous = p.place AND a.next = q.place
  LEFT JOIN pairs b ON NOT b.random AND b.previous = p.place AND b.next = q.place
  LEFT JOIN totals s ON s.random AND s.previous = p.place
  LEFT JOIN totals t ON NOT t.random AND t.previous = p.place
  LEFT JOIN shapes f ON f.class = p.class AND f.following = q.class
),
ratios AS MATERIALIZED (
  SELECT previous, next, CASE WHEN previous = next THEN least(0.0::DOUBLE, ratio) ELSE ratio END AS ratio
  FROM (
    SELECT previous, next, ln(random) - ln(CASE WHEN EXISTS (SELECT 1 FROM totals)
      THEN 0.96::DOUBLE * ordinary + 0.04::DOUBLE * (shaped + 1.0::DOUBLE / {len(_CHARACTERS) + 1}) / 2 ELSE ordinary END) AS ratio
    FROM counted)
),
whole AS MATERIALIZED ({_places("random", 3, "[A-Za-z0-9+/_=-]{16,}", 0, 0)}),
cut AS (
  SELECT w.id, w.start_, w.end_, b.start_ AS until, b.end_ AS again, b.rank
  FROM whole w JOIN base b ON b.id = w.id AND b.start_ < w.end_ AND w.start_ < b.end_
),
pieces AS (
  SELECT id, greatest(start_, coalesce(max(again) OVER (
    PARTITION BY id, start_ ORDER BY until, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start_)) AS start_, until AS end_
  FROM cut
  UNION ALL
  SELECT w.id, greatest(w.start_, coalesce(max(again), w.start_)), w.end_
  FROM whole w LEFT JOIN cut c ON c.id = w.id AND c.start_ = w.start_ GROUP BY w.id, w.start_, w.end_
),
runs AS MATERIALIZED (
  SELECT id, 3 AS rank, 'random' AS kind, start_, end_, substr(text, start_::BIGINT + 1, (end_ - start_)::BIGINT) AS value
  FROM pieces JOIN docs USING (id) WHERE end_ - start_ >= 16
),
scored AS (
  SELECT r.id, r.rank, r.kind, r.start_, r.end_
  FROM ({_steps("SELECT id, rank, kind, start_, end_, value AS token FROM runs")}) r
  JOIN ratios USING (previous, next)
  GROUP BY ALL HAVING sum(ratio) >= 12
),
spans AS (
  SELECT id, rank, kind, start_, end_ FROM base
  UNION ALL
  SELECT * FROM scored
),
listed AS (
  SELECT id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex,
    coalesce(string_agg(span, ',' ORDER BY start_, rank) FILTER (rank < 3), '') AS own,
    string_agg(span, ',' ORDER BY start_, rank) AS spans
  FROM (SELECT *, kind || ':' || start_ || ':' || end_ AS span FROM spans) GROUP BY id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (id)
"""

#: The tree level by level, then every row folded upwards beside its run.
MERKLE = """
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, source, lang, n_chars, text,
    list_reduce(
      list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda v, step: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) AS crc
  FROM documents
),
spelled AS (
  SELECT id, doc_id, lang, xor(crc, 4294967295::UBIGINT) % 3 = 0 AS tampered, text,
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(octet_length(encode(text)) || ':', '-') AS size
  FROM docs
),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT id, doc_id, lang, sha256(head || size || coalesce(text, '')) AS leaf,
      CASE WHEN tampered THEN sha256(head || size || coalesce(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''))
      ELSE sha256(head || size || coalesce(text, '')) END AS found
    FROM spelled)
),
nodes(level, lang, pos, n, h) AS (
  SELECT 0, lang, pos, n, leaf FROM leaves
  UNION ALL
  SELECT level + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, lang, pos // 8, n
),
subroots AS MATERIALIZED (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
tops(level, pos, n, h) AS (
  SELECT 0, pos, n, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 8, n
),
runs AS MATERIALIZED (
  SELECT level, lang, pos // 8 AS run, list(h ORDER BY pos) AS members FROM nodes WHERE n > 1 GROUP BY ALL
),
top_runs AS MATERIALIZED (
  SELECT level, pos // 8 AS run, list(h ORDER BY pos) AS members FROM tops WHERE n > 1 GROUP BY ALL
),
climb(id, lang, level, pos, node, proof) AS (
  SELECT id, lang, 0, pos, found, '' FROM leaves
  UNION ALL
  SELECT id, c.lang, c.level + 1, run,
    sha256(array_to_string(list_concat(members[:pos % 8], [node], members[pos % 8 + 2:]), '')),
    proof || array_to_string(list_concat(members[:pos % 8], members[pos % 8 + 2:]), '')
  FROM climb c JOIN runs r ON r.level = c.level AND r.lang IS NOT DISTINCT FROM c.lang AND r.run = c.pos // 8
),
arrived AS (
  SELECT id, s.pos, c.node, proof, s.h AS subroot FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang
  QUALIFY level = max(level) OVER (PARTITION BY id)
),
finish(id, level, pos, node, proof, subroot) AS (
  SELECT id, 0, pos, node, proof, subroot FROM arrived
  UNION ALL
  SELECT id, f.level + 1, run,
    sha256(array_to_string(list_concat(members[:pos % 8], [node], members[pos % 8 + 2:]), '')),
    proof || array_to_string(list_concat(members[:pos % 8], members[pos % 8 + 2:]), ''), subroot
  FROM finish f JOIN top_runs r ON r.level = f.level AND r.run = f.pos // 8
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM (SELECT * FROM finish QUALIFY level = max(level) OVER (PARTITION BY id))
JOIN leaves USING (id) CROSS JOIN (SELECT h AS root FROM tops WHERE n = 1)
"""

#: Overlaps of all pairs with a shingle in common, then reachability.
NGRAM_JACCARD = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS MATERIALIZED (
  SELECT id, doc_id, list_distinct(list_transform(
    generate_series(1, greatest(len(w) - 4, least(len(w), 1))), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words
),
shingles AS MATERIALIZED (SELECT id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a.id AS x, b.id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach(x, y) AS (
  SELECT id, id FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT any_value(own.doc_id) AS doc_id, any_value(len(own.s))::BIGINT AS n_shingles, min(other.doc_id) AS component_id
FROM reach JOIN sets own ON own.id = reach.x JOIN sets other ON other.id = reach.y GROUP BY reach.x
"""

#: Every anchor with every row.
HARD_NEGATIVES = """
WITH rows_ AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS whole
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS MATERIALIZED (
  SELECT a.id AS anchor, a.vec_id AS anchor_id, b.id, b.vec_id, a.label = b.label AS same,
    list_inner_product(a.whole, b.whole)::BIGINT AS score
  FROM rows_ a JOIN rows_ b ON a.id <> b.id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor, anchor_id, id AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id) <= 10
"""

STATEMENTS = {
    "op5_secret_scan": SECRETS,
    "op7_url_filter": URL_FILTER,
    "op11_ngram_jaccard": NGRAM_JACCARD,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_merkle_manifest": MERKLE,
}
