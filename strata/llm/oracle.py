"""DuckDB SQL of the registered queries that SQL can express. The values are
written out here on their own, not taken from the operators."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m,
         array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM bw, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0),
ms AS (SELECT DISTINCT m FROM win),
pos AS (
  SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM dw, ms, unnest(range(1, len(w) - m + 2)) AS t(i) WHERE len(w) >= m),
hit AS (SELECT p.doc_id, p.i, p.m, win.item_id FROM pos p JOIN win ON p.win = win.win AND p.m = win.m),
cov AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw d LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0
         AND len(list_filter(embedding, lambda y: y <> 0)) > 0 AS ok
  FROM embeddings),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.ok AND b.ok
  WHERE list_dot_product(a.x, b.x)
        / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.95),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
m AS (SELECT digest, n, max(page_id) AS first_id FROM p WHERE n >= 1000 GROUP BY digest, n)
SELECT page_id, p.n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN m ON m.digest = p.digest AND m.n = p.n
"""

_KINDS = [
    ("assign", 0, r"""(?i)(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""",
     2, 6),
    ("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", 2, r"[0-9a-f]+", 0, 24),
    ("owned", 3, r"[A-Za-z0-9+/_=-]+", 0, 20),
]


def _kind(name: str, rank: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("\\'", "''")
    return f"""
  SELECT doc_id, owner, repository, '{name}' AS kind, {rank} AS rank, i, g, w, v[i] AS value
  FROM (SELECT doc_id, owner, repository, regexp_split_to_array(t, '{p}') AS g,
               regexp_extract_all(t, '{p}', 0) AS w, regexp_extract_all(t, '{p}', {group}) AS v FROM d),
       unnest(range(1, len(w) + 1)) AS r(i)
  WHERE length(v[i]) >= {least}"""


SECRETS = rf"""
WITH d AS (SELECT doc_id, source AS owner, source || '/' || lang AS repository, coalesce(text, '') AS t
           FROM documents),
m AS ({" UNION ALL ".join(_kind(*k) for k in _KINDS)}),
s AS (
  SELECT doc_id, owner, repository, kind, rank, value, start, start + length(w[i]) AS stop
  FROM (SELECT *, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
                  + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0) AS start FROM m)
  WHERE kind <> 'owned' OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
        AND len(list_distinct(string_split(value, ''))) >= 10)),
o AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT repository) AS repositories
      FROM s GROUP BY value),
f AS (
  SELECT s.*, owners, repositories FROM s JOIN o USING (value)
  WHERE kind <> 'owned' OR ((owners < 2 OR (owners < 3 AND repositories < 5)) AND NOT EXISTS (
    SELECT 1 FROM s b WHERE b.doc_id = s.doc_id AND b.kind <> 'owned'
                        AND b.start < s.stop AND b.stop > s.start))),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ','
                    ORDER BY start, rank) FILTER (kind <> 'owned') AS base,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ','
                    ORDER BY start, rank) AS spans,
         string_agg(CAST(owners AS VARCHAR), ',' ORDER BY start, rank) AS owners,
         string_agg(CAST(repositories AS VARCHAR), ',' ORDER BY start, rank) AS repositories
  FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(owners, '') AS owners, coalesce(repositories, '') AS repositories
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""

_NOTICES = [
    ("MIT", "released under the mit license"), ("MIT", "licensed under the mit license"),
    ("MIT", "spdx license identifier mit"),
    ("Apache-2.0", "licensed under the apache license version 2 0"),
    ("Apache-2.0", "spdx license identifier apache 2 0"),
    ("GPL-3.0-only", "this work is licensed under the gnu general public license version 3"),
    ("GPL-3.0-only", "spdx license identifier gpl 3 0 only"),
    ("GPL-2.0-only", "this work is licensed under the gnu general public license version 2"),
    ("BSD-3-Clause", "licensed under the bsd 3 clause license"),
    ("CC-BY-4.0", "licensed under cc by 4 0"), ("CC-BY-SA-4.0", "licensed under cc by sa 4 0"),
    ("CC-BY-NC-4.0", "licensed under cc by nc 4 0"),
]
# of the equivalent spellings, those that the notices above or the test tables hold
_CANON = (r"regexp_replace(trim(regexp_replace(translate({t}, '" + _UP + "', '" + _LOW + r"'), "
          r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), '\blicence\b', 'license', 'g')")

LICENSES = rf"""
WITH k(license, form) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _NOTICES)}),
d AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)),
             lambda x: NOT regexp_matches(x, '^[ \t]*(?i)(copyright|\(c\)|\x{{A9}})')) AS ls FROM documents),
w AS (SELECT doc_id, {_CANON.format(t="array_to_string(ls, chr(10))")} AS form FROM d),
l AS (SELECT doc_id, license, count(*) AS n FROM (
        SELECT doc_id, {_CANON.format(t="line")} AS form FROM (SELECT doc_id, unnest(ls) AS line FROM d))
      JOIN k USING (form) GROUP BY doc_id, license),
u AS (SELECT doc_id, license, n FROM l UNION ALL SELECT doc_id, license, 0 FROM w JOIN k USING (form)),
a AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
      FROM u GROUP BY doc_id)
SELECT w.doc_id, sha256(w.form) AS canonical_sha256, k.license AS text_license,
       coalesce(a.n, 0) AS n_license_lines, coalesce(a.licenses, '') AS licenses
FROM w LEFT JOIN k ON k.form = w.form LEFT JOIN a ON a.doc_id = w.doc_id
"""

LEXICAL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
c AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
s AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""

ORACLE_SQL = {
    "op1_decontamination": DECONTAMINATION,
    "op2_embedding_dedup": EMBEDDINGS,
    "op4_warc": WARC,
    "op7_license_scan": LICENSES,
    "op9_secret_scan": SECRETS,
    "op11_lexical_search": LEXICAL,
}
