"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

# Runs are compared as lists of lines instead of hashes.
LINE_DEDUP = r"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
pieces AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM docs),
l AS (SELECT doc_id, pos, trim(line, ' ') AS line, line AS raw, len(regexp_extract_all(line, '[^ \t\n\x0b\f\r]+')) AS words
      FROM pieces),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS through FROM l WHERE words > 0),
b AS (SELECT *, through - words AS before FROM c),
runs AS (
  SELECT doc_id, min(pos) OVER w AS first, max(pos) OVER w AS last, sum(words) OVER w AS total, list(line) OVER w AS run
  FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, min(pos) OVER w, max(pos) OVER w, sum(words) OVER w, list(line) OVER w
  FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY through RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
origins AS (SELECT run, min({'d': doc_id, 'f': first, 'l': last}) AS o FROM runs WHERE total >= 50 GROUP BY run),
later AS (SELECT r.doc_id, r.first, r.last, o.o.d AS origin_id FROM runs r JOIN origins o ON r.run = o.run
          WHERE r.total >= 50 AND (r.doc_id <> o.o.d OR r.first > o.o.l)),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM later JOIN l ON l.doc_id = later.doc_id
         AND l.pos BETWEEN later.first AND later.last WHERE l.words > 0),
ids AS (SELECT doc_id, string_agg(origin_id::varchar, ',' ORDER BY origin_id) AS first_ids
        FROM (SELECT DISTINCT doc_id, origin_id FROM later) GROUP BY doc_id)
SELECT l.doc_id,
       coalesce(string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text,
       count(*)::int AS n_lines, count(g.pos)::int AS n_removed,
       coalesce(string_agg(g.pos::varchar, ',' ORDER BY g.pos), '') AS removed_lines,
       coalesce(any_value(ids.first_ids), '') AS first_ids
FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
LEFT JOIN ids ON ids.doc_id = l.doc_id
GROUP BY l.doc_id
"""

_RULES = """(VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                    ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS r(action, host, path)"""

_PARTS = r"""regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*')"""

# Aliases: urls without tracking parameters, canonical, og:url and refresh links of all forms.
_LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ORIGIN = "regexp_extract({u}, '^[^:/?#]+://[^/?#]*')"


def _node(u: str) -> str:
    """The url without fragment, scheme and host in lower case."""
    u = f"regexp_replace({u}, '(?s)#.*$', '')"
    origin = _ORIGIN.format(u=u)
    return f"({_LOWER.format(c=origin)} || substr({u}, length({origin}) + 1))"


def _decoded(t: str) -> str:
    for pattern, char in (("&quot;|&#34;|&#[xX]22;", '"'), ("&apos;|&#39;|&#[xX]27;", "''"), ("&lt;|&#60;|&#[xX]3[cC];", "<"),
                          ("&gt;|&#62;|&#[xX]3[eE];", ">"), ("&#47;|&#[xX]2[fF];", "/"), ("&amp;|&#38;|&#[xX]26;", "&")):
        t = f"regexp_replace({t}, '{pattern}', '{char}', 'g')"
    return t


def _tags(tag: str, wanted: str, attribute: str) -> list[str]:
    value = rf"""\b{attribute}\s*=\s*["'']?([^"''>\s]+)"""
    return [rf"regexp_extract_all(html, '(?is)<{tag}\b[^>]*{wanted}[^>]*?{value}', 1)",
            rf"regexp_extract_all(html, '(?is)<{tag}\b[^>]*?{value}[^>]*{wanted}', 1)"]


_LINKS = " || ".join([*_tags("link", r"""rel\s*=\s*["'']?canonical""", "href"),
                      *_tags("meta", r"""property\s*=\s*["'']?og:url""", "content"),
                      r"""regexp_extract_all(html, '(?is)<meta\b[^>]*http-equiv\s*=\s*["'']?refresh[^>]*?url\s*=\s*([^"''>\s]+)', 1)"""])

URL_FILTER = rf"""
WITH RECURSIVE p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, {_node("coalesce(url, '')")} AS node FROM pages),
d AS (
  SELECT DISTINCT url, node, {_ORIGIN.format(u="url")} AS origin,
         regexp_extract(substr(url, length({_ORIGIN.format(u="url")}) + 1), '^[^?#]*') AS path,
         {_decoded("target")} AS target
  FROM (SELECT url, node, unnest({_LINKS}) AS target FROM p WHERE url <> '')),
f AS (
  SELECT *, CASE WHEN starts_with(target, '/') THEN target
                 ELSE (CASE WHEN contains(path, '/') THEN regexp_extract(path, '(?s)^.*/') ELSE '/' END) || target END AS whole
  FROM d),
w AS (
  SELECT *, string_split(regexp_replace(whole, '(?s)\?.*$', ''), '/') AS steps, regexp_extract(whole, '(?s)\?.*$') AS tail FROM f),
t AS (
  SELECT node, CASE
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') OR target = '' OR starts_with(target, '#') OR origin = '' THEN NULL
    WHEN starts_with(target, '//') THEN regexp_extract(origin, '^[^:]+:') || target
    WHEN starts_with(target, '?') THEN origin || path || target
    ELSE origin || array_to_string(list_reduce(list_prepend([]::varchar[], list_transform(steps, lambda x: [x])),
           lambda a, x: CASE x[1] WHEN '.' THEN a WHEN '..' THEN a[1:greatest(len(a) - 1, 1)] ELSE a || x END), '/')
         || CASE WHEN steps[-1] IN ('.', '..') THEN '/' ELSE '' END || tail END AS target
  FROM w),
e AS (
  SELECT node AS a, {_node("target")} AS b FROM t WHERE target IS NOT NULL
  UNION
  SELECT node, regexp_replace(regexp_replace(node, '([?&])(?:(?:utm_[a-z]+|ref|fbclid|gclid|mc_eid)=[^&]*(?:&|$))+', '\1', 'g'),
                              '[?&]$', '') FROM p WHERE url <> ''),
links AS (SELECT a, b FROM e WHERE a <> b AND contains(b, '://') UNION SELECT b, a FROM e WHERE a <> b AND contains(b, '://')),
reach AS (SELECT DISTINCT a AS x, a AS y FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a),
urls AS (SELECT url FROM p UNION SELECT a FROM links),
parts AS (SELECT url, CASE WHEN contains(url, '://') THEN {_LOWER.format(c=_PARTS.format(u='url'))} ELSE '' END AS host,
                 CASE WHEN contains(url, '://') THEN regexp_extract(substr(substr(url, strpos(url, '://') + 3),
                 length({_PARTS.format(u='url')}) + 1), '^[^?#]*') ELSE '' END AS path FROM urls),
fits AS (SELECT url, max({{'n': length(r.host) + length(r.path), 'a': (r.action = 'allow')::int, 'rule': r.host || r.path}}) AS best
         FROM parts JOIN {_RULES} ON parts.host <> '' AND (parts.host = r.host OR ends_with(parts.host, '.' || r.host))
         AND starts_with(parts.path, r.path) GROUP BY url),
votes AS (SELECT x, max(f.best.a) AS allowed FROM reach JOIN fits f ON f.url = reach.y GROUP BY x)
SELECT p.page_id, q.host, q.path, f.best.rule AS rule,
       CASE coalesce(f.best.a, v.allowed, 1) WHEN 1 THEN 'allow' ELSE 'block' END AS verdict
FROM p JOIN parts q ON q.url = p.url LEFT JOIN fits f ON f.url = p.url LEFT JOIN votes v ON v.x = p.node
"""

LEXICAL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
lens AS (SELECT r, doc_id, len(t)::bigint AS n FROM d WHERE len(t) > 0),
stats AS (SELECT count(*)::bigint AS docs, sum(n)::bigint AS total FROM lens),
tfs AS (SELECT r, term, count(*)::bigint AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint AS w
      FROM tfs, stats GROUP BY term, docs),
p AS (SELECT doc_id, tfs.r, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)) AS p
      FROM tfs JOIN lens USING (r), stats WHERE doc_id IS NOT NULL),
s AS (SELECT item_id, doc_id, r, sum(w * p)::bigint AS score FROM items JOIN w USING (term) JOIN p USING (term)
      GROUP BY item_id, doc_id, r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::int AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

# Trees are built level by level; a second recursion climbs from every leaf.  crc32 is computed bit by bit.
MERKLE = r"""
WITH RECURSIVE
field AS (SELECT doc_id, source, coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-')
            || coalesce(octet_length(encode(source)) || ':' || source, '-')
            || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
            || coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-') AS head, text,
          list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
            lambda a, c: list_reduce(list_prepend(xor(a, c), [1::bigint, 2, 3, 4, 5, 6, 7, 8]),
              lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS crc FROM documents),
leaves AS (SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(octet_length(encode(t2)) || ':' || t2, '-')) AS changed
           FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t2 FROM field)),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
trees(source, level, pos, h, n) AS (
  SELECT source, 0, pos, leaf, count(*) OVER (PARTITION BY source) FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM trees WHERE n > 1 GROUP BY source, level, pos // 3, n),
subroots AS (SELECT source, level, h, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS pos
             FROM trees WHERE n = 1),
top(level, pos, h, n) AS (
  SELECT 0, pos, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
nodes AS (SELECT '1' || coalesce('=' || source, '') AS tree, level, pos, h, n FROM trees WHERE n > 1
          UNION ALL SELECT '2', level, pos, h, n FROM top WHERE n > 1),
links AS (SELECT a.tree, a.level, a.pos,
            coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
            coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
          FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
          GROUP BY a.tree, a.level, a.pos),
climb(doc_id, leaf, subroot, subpos, tree, level, pos, last, folded, proof) AS (
  SELECT p.doc_id, p.leaf, s.h, s.pos, '1' || coalesce('=' || p.source, ''), 0, p.pos, s.level, p.changed, ''
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.subpos, x.tree, x.level + 1, x.pos // 3, c.last,
         sha256(x.l || c.folded || x.r), c.proof || x.l || x.r
  FROM climb c JOIN links x
    ON x.tree = CASE WHEN c.tree <> '2' AND c.level = c.last THEN '2' ELSE c.tree END
   AND x.level = CASE WHEN c.tree <> '2' AND c.level = c.last THEN 0 ELSE c.level END
   AND x.pos = CASE WHEN c.tree <> '2' AND c.level = c.last THEN c.subpos ELSE c.pos END),
root AS (SELECT h, level FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.h AS verified
FROM climb, root
WHERE (climb.tree = '2' AND climb.level = root.level) OR (root.level = 0 AND climb.tree <> '2' AND climb.level = climb.last)
"""

ORACLE = {"op8_url_filter": URL_FILTER, "op9_line_dedup": LINE_DEDUP, "op12_merkle_manifest": MERKLE,
          "op13_lexical_search": LEXICAL}
