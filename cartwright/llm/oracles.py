"""The numbered operators in SQL, where SQL can express them.

Not here: scores that need a compressor (1), hashes that SQL engines do not share (4), a
vocabulary file (6), learned profiles (7).
"""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP2 = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
places AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM places),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_shared
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * n_shared >= 85 * (p.n + q.n - n_shared)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

_OP3 = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS MATERIALIZED (
  SELECT doc_id, line, place, trim(translate(line, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), {_BLANKS}) AS key
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split)),
held AS (
  SELECT key, min(doc_id) AS first FROM placed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT p.*, h.first IS NOT NULL AND h.first <> p.doc_id AS gone FROM placed p LEFT JOIN held h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_OP5 = r"""
WITH turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
    row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS turns
  FROM conversations WHERE conv_id IS NOT NULL
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, ''))),
so_far AS MATERIALIZED (
  SELECT conv_id, n, turns,
    list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY n) AS said FROM turns),
ends AS (SELECT min(conv_id) AS conv_id, said FROM so_far WHERE n = turns GROUP BY said),
kept AS (
  SELECT conv_id FROM ends e WHERE NOT EXISTS (SELECT 1 FROM so_far s WHERE s.n < s.turns AND s.said = e.said))
SELECT conv_id, count(*) AS n_turns,
  string_agg('<|im_start|>' ||
    translate(regexp_replace(role, '<\|(im_start|im_end)\|>', '<\1>', 'g'), chr(10) || chr(13), '  ') || chr(10) ||
    regexp_replace(text, '<\|(im_start|im_end)\|>', '<\1>', 'g') || '<|im_end|>' || chr(10), '' ORDER BY n) AS rendered
FROM turns JOIN kept USING (conv_id) GROUP BY conv_id
"""

_MATCH_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP8 = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_MATCH_WORDS.format(_LOWER)} AS w FROM documents),
items AS MATERIALIZED (SELECT item_id, {_MATCH_WORDS.format(_LOWER)} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
found AS MATERIALIZED (
  SELECT doc_id, p.i, p.size, item_id FROM places p JOIN windows v ON v.size = p.size AND v.s = p.s),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP9 = f"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
    CASE WHEN text IS NULL THEN 0 ELSE CAST(len({_WORDS.format('text')}) AS BIGINT) END AS size,
    md5('mix:' || CAST(doc_id AS VARCHAR)) AS tag FROM documents),
sources AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY key),
weighed AS (
  SELECT *, CAST([1, 2, 3][(row_number() OVER (ORDER BY key) - 1) % 3 + 1] AS DOUBLE) AS weight FROM sources),
asked AS (
  SELECT *, CAST(floor(weight / sum(weight) OVER () * 1.0 * 1e12 + 0.5) AS BIGINT) AS demand,
    3 * source_size AS most, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM weighed),
ordered AS (
  SELECT *, CAST(sum(most) OVER o AS BIGINT) - most AS before,
    CAST(sum(demand) OVER () AS BIGINT) - CAST(sum(demand) OVER o AS BIGINT) + demand AS demand_left
  FROM asked WINDOW o AS (ORDER BY CAST(most AS DOUBLE) / demand, key)),
judged AS (
  SELECT *, CAST(most AS DOUBLE) * demand_left <= CAST(demand AS DOUBLE) * (total - before) AS is_full FROM ordered),
targets AS (
  SELECT key, source_size, demand, CASE WHEN is_full THEN CAST(most AS DOUBLE) ELSE
    CAST(demand AS DOUBLE) * CAST(total - coalesce(sum(most) FILTER (is_full) OVER (), 0) AS DOUBLE)
      / CAST(sum(demand) FILTER (NOT is_full) OVER () AS DOUBLE) END AS target
  FROM judged),
placed AS (
  SELECT doc_id, size, source_size, target, demand, CAST(floor(target + 0.5) AS BIGINT) AS wanted,
    CAST(sum(size) OVER (PARTITION BY key ORDER BY tag, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM sized JOIN targets USING (key)),
taken AS (
  SELECT *, [greatest(0, least(size, wanted - source_size * e - start)) FOR e IN [0, 1, 2]] AS parts FROM placed)
SELECT doc_id, size, source_size, target, CAST(list_sum(parts) AS BIGINT) AS taken,
  CAST(len([p FOR p IN parts IF p > 0]) AS INTEGER) AS copies,
  CASE WHEN parts[1] > 0 THEN start / target * demand / demand END AS position
FROM taken
"""

_OP10 = f"""
WITH rules(action, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
best AS (
  SELECT p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.action, length(r.host || r.path)) AS action
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""

ORACLES: dict[str, str] = {
    "op2_ngram_join": _OP2,
    "op3_line_dedup": _OP3,
    "op5_chat": _OP5,
    "op8_decontaminate": _OP8,
    "op9_mix": _OP9,
    "op10_url_filter": _OP10,
}
