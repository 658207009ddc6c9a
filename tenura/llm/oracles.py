"""DuckDB SQL for the queries that SQL can express at a small scale."""

from __future__ import annotations

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_FILTERS = f"""
WITH RECURSIVE rules (host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
known AS (SELECT page_id, url, html, split_part(url, '://', 1) AS scheme FROM pages WHERE contains(url, '://')),
tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^<>]*>')) AS tag FROM known),
targets AS (
  SELECT url, trim(regexp_replace(CASE
      WHEN lower(tag) LIKE '<link%' AND (list_contains(string_split(lower(regexp_extract(tag, '(?is)\\brel\\s*=\\s*"([^"]*)', 1)), ' '),
          'canonical') OR list_contains(string_split(lower(regexp_extract(tag, '(?is)\\brel\\s*=\\s*''([^'']*)', 1)), ' '), 'canonical')
          OR regexp_matches(tag, '(?is)\\brel\\s*=\\s*canonical\\b'))
        THEN concat(regexp_extract(tag, '(?is)\\bhref\\s*=\\s*"([^"]*)', 1), regexp_extract(tag, '(?is)\\bhref\\s*=\\s*''([^'']*)', 1),
          regexp_extract(tag, '(?is)\\bhref\\s*=\\s*([^\\s"''>]+)', 1))
      WHEN lower(tag) LIKE '<meta%' AND regexp_matches(tag, '(?is)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')
        THEN regexp_extract(tag, '(?is)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1) END, '(?i)&(?:amp|#38|#x26);', '&', 'g')) AS t FROM tags),
parts AS (
  SELECT url, t, split_part(url, '://', 1) AS scheme, regexp_extract(url, '^.*?(://[^/?#]*)', 1) AS place,
    regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) AS own, regexp_extract(t, '^[^?#]*') AS p FROM targets
  WHERE t <> '' AND NOT starts_with(t, '#')),
merged AS (
  SELECT *, CASE WHEN starts_with(p, '/') THEN p WHEN p = '' THEN own
      ELSE coalesce(nullif(regexp_extract(own, '^.*/'), ''), '/') || p END AS m FROM parts),
linked AS (
  SELECT url AS a, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN t WHEN starts_with(t, '//') THEN scheme || ':' || t
    ELSE scheme || place || CASE WHEN m = '' THEN '' ELSE array_to_string(list_reduce(string_split(m, '/')[2:], lambda done, x:
      CASE WHEN x = '..' THEN done[1:greatest(len(done) - 1, 1)] WHEN x = '.' THEN done ELSE list_append(done, x) END, ['']), '/')
      || CASE WHEN string_split(m, '/')[-1] IN ('.', '..') THEN '/' ELSE '' END END || substr(t, length(p) + 1) END AS b
  FROM merged),
named AS (
  SELECT DISTINCT url, substr(url, strpos(url, '://') + 3) AS rest
  FROM (SELECT url FROM known UNION ALL SELECT b FROM linked WHERE contains(b, '://')) x),
plain AS (
  SELECT url AS a, 'https://' || {_FOLD.format("regexp_extract(rest, '^[^/?#]*')")}
    || rtrim(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/')
    || coalesce('?' || nullif(array_to_string(list_filter(
      string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
      lambda q: q <> '' AND NOT list_contains(['utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'ref',
        'gclid', 'fbclid', 'sessionid'], split_part(q, '=', 1))), '&'), ''), '') AS b
  FROM named WHERE lower(split_part(url, '://', 1)) IN ('http', 'https')),
edges AS (
  SELECT DISTINCT a, b FROM (SELECT * FROM linked UNION ALL SELECT * FROM plain) x
  WHERE contains(a, '://') AND contains(b, '://') AND a <> b),
either AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a, b FROM either UNION SELECT r.a, e.b FROM reach r JOIN either e ON r.b = e.a),
nodes AS (
  SELECT url, {_FOLD.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT url, substr(url, strpos(url, '://') + 3) AS rest FROM (
    SELECT url FROM known UNION SELECT a FROM edges UNION SELECT b FROM edges) y) z),
own AS (
  SELECT n.url, any_value(n.host) AS host, any_value(n.path) AS path,
    arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM nodes n LEFT JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
  GROUP BY n.url),
told AS (SELECT a AS url, min(verdict) AS verdict FROM reach JOIN own ON own.url = b GROUP BY a)
SELECT page_id, coalesce(own.host, '') AS host, coalesce(own.path, '') AS path, own.rule AS rule,
  coalesce(own.verdict, told.verdict, 'allow') AS verdict
FROM pages LEFT JOIN own ON own.url = pages.url LEFT JOIN told ON told.url = pages.url
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE sets AS (
  SELECT doc_id, list_distinct(if(len(w) = 1, w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS s
  FROM (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents) x),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM each x JOIN each y
    ON x.g = y.g AND x.doc_id < y.doc_id AND 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM either UNION SELECT r.a, e.b FROM reach r JOIN either e ON r.b = e.a),
least AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM sets LEFT JOIN least USING (doc_id)
"""

_WORD = "[^\\x20\\x09-\\x0D]+"
_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}


def _grams(n: int) -> str:
    """Windows of ``n`` words with how often they occur in the text and how often before."""
    return f"""
g{n} AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) - 1 AS earlier,
    count(*) OVER (PARTITION BY doc_id, k) AS times
  FROM (SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM texts) x) y),
a{n} AS (
  SELECT doc_id, sum(length(w[p])) AS chars FROM texts JOIN (
    SELECT DISTINCT doc_id, i + unnest(range({n})) AS p FROM g{n} WHERE earlier > 0) x USING (doc_id) GROUP BY doc_id)"""


QUALITY_RULES = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
lines AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) - 1 AS earlier,
    length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS line_no FROM texts) x
  WHERE regexp_matches(line, '{_WORD}')),
line_sums AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (earlier > 0) AS n_dup_lines,
    coalesce(sum(chars) FILTER (earlier > 0), 0) AS dup_line_chars
  FROM lines GROUP BY doc_id),{','.join(_grams(n) for n in _LIMITS)},
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT doc_id, i + unnest(range(8)) AS p FROM g8 WHERE times > 1) x GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    coalesce(dup_line_chars, 0) AS dup_line_chars,
    {', '.join(f'coalesce(a{n}.chars, 0) AS dup_{n}gram_chars' for n in _LIMITS)}
  FROM texts LEFT JOIN line_sums USING (doc_id) LEFT JOIN repeats USING (doc_id)
    {' '.join(f'LEFT JOIN a{n} USING (doc_id)' for n in _LIMITS)})
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR (n_dup_lines > 0.30 * n_lines AND n_lines >= 5)
    OR dup_line_chars > 0.20 * word_chars OR {' OR '.join(f'dup_{n}gram_chars > {x} * word_chars' for n, x in _LIMITS.items())})
    AS kept
FROM counts
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER best AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN met m ON m.anchor_id = p.anchor_id AND NOT m.same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 3
"""

FILL_IN_MIDDLE = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM texts),
cut AS (
  SELECT doc_id, text, n, form, least(a, b) AS i, greatest(a, b) AS j, substr(text, 1, least(a, b)) AS p,
    substr(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m, substr(text, greatest(a, b) + 1) AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
