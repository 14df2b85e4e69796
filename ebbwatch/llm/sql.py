"""The queries that SQL can state, in the dialect of DuckDB."""

from __future__ import annotations

from ebbwatch.llm.licenses import TEMPLATES, half_block
from ebbwatch.llm.urls import RULES, SPAM_HOSTS

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"regexp_extract_all({_LOWERED.format(text)}, '{_WORD}')"


_OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce({_words("text")}, []) AS w FROM documents),
b AS (SELECT item_id, {_words("text")} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
grams AS (SELECT DISTINCT n, g FROM win),
sizes AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT row_no, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT row_no, i, n, g FROM places JOIN grams USING (n, g)),
covered AS (
  SELECT row_no, count(DISTINCT p) AS n_hit
  FROM (SELECT row_no, unnest(range(i, i + n)) AS p FROM hits) GROUP BY row_no),
items AS (
  SELECT row_no, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS ids
  FROM (SELECT DISTINCT row_no, n, g FROM hits) JOIN win USING (n, g) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row_no) LEFT JOIN items USING (row_no)
"""

_TEMPLATE_ROWS = ", ".join(
    f"('{label}', list_distinct({_words(repr(text))}), ' {needed} ', {half_block(text)})" for label, needed, text in TEMPLATES
)

_OP2 = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
t AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS x(label, words, needed, half)),
phrase AS (SELECT label, str_split(p, ' ') AS words FROM (VALUES
  ('cc-by', 'cc by'), ('gpl', 'general public license'), ('reserved', 'all rights reserved')) AS x(label, p)),
placed AS (
  SELECT row_no, label, i FROM (SELECT row_no, w, unnest(range(1, len(w) + 1)) AS i FROM d), phrase
  WHERE list_slice(w, i, i + len(words) - 1) = words),
base AS (
  SELECT row_no, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word,
    list_sort(list_distinct(list(label))) AS base_labels
  FROM placed GROUP BY row_no),
halves AS (SELECT DISTINCT half FROM t),
blocks AS (
  SELECT row_no, half, list_distinct(list_slice(w, half * b + 1, half * (b + 2))) AS held,
    ' ' || array_to_string(list_slice(w, half * b + 1, half * (b + 2)), ' ') || ' ' AS inside
  FROM (SELECT row_no, w, half, unnest(range(0, CAST(greatest(0, ceil(len(w) / half) - 2) AS BIGINT) + 1)) AS b FROM d, halves)),
shares AS (
  SELECT row_no, label, len(list_intersect(held, words)) AS shared, len(words) AS m
  FROM blocks JOIN t USING (half) WHERE contains(inside, needed)),
found AS (
  SELECT row_no, list_distinct(list(label)) AS labels, max(CAST(shared AS DOUBLE) / m) AS score
  FROM shares WHERE shared >= ceil(0.8 * m - 1e-9) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(base_labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (row_no) LEFT JOIN found USING (row_no)
"""

_OP4 = """
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)]::DOUBLE AS weight
  FROM d GROUP BY source),
lev AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0.0::DOUBLE))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0::DOUBLE)) AS level,
    row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS cap_rank
  FROM s WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (
  SELECT source, source_size,
    CASE WHEN cap <= level * weight THEN cap
      ELSE weight * first_value(level) OVER (ORDER BY cap <= level * weight, cap_rank) END AS target
  FROM lev),
t2 AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS whole FROM tgt),
t3 AS (SELECT *, greatest(0.0, target - whole * source_size) AS rest FROM t2),
mean AS (
  SELECT source, sum(floor(sqrt(size)) * size) / nullif(sum(size), 0) AS w FROM d GROUP BY source),
share AS (
  SELECT row_no, CASE WHEN source_size > 0 THEN rest / source_size ELSE 0.0 END AS s, floor(sqrt(size)) / mean.w AS r
  FROM d JOIN t3 ON d.source IS NOT DISTINCT FROM t3.source JOIN mean ON d.source IS NOT DISTINCT FROM mean.source),
odd AS (
  SELECT row_no, least(1 - 1e-9::DOUBLE, greatest(1e-9::DOUBLE, s)) AS usual,
    greatest(1e-9::DOUBLE, s * coalesce(r, 1.0)) AS p FROM share),
o AS (
  SELECT d.row_no, d.doc_id, d.source, d.size, t3.source_size, target, whole, rest,
    CASE WHEN p >= 1 - 1e-9::DOUBLE THEN u - 1 ELSE (u / (1 - u)) * (usual / (1 - usual)) / (p / (1 - p)) END AS odds
  FROM (SELECT *, (CAST('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0::DOUBLE AS u FROM d) d
  JOIN t3 ON d.source IS NOT DISTINCT FROM t3.source
  JOIN odd ON d.row_no = odd.row_no),
h AS (
  SELECT *, CASE WHEN sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id, size, row_no) <= rest THEN 1 ELSE 0 END AS more FROM o),
g AS (SELECT *, rest - sum(size * more) OVER (PARTITION BY source) AS gap FROM h),
f AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY
    CASE WHEN more = 0 AND size > 0 AND size < 2 * gap THEN 0 ELSE 1 END, abs(size - gap), odds, doc_id, size, row_no) AS place
  FROM g)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN more = 1 OR (place = 1 AND size > 0 AND size < 2 * gap) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM f
"""

_OP6 = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (
  SELECT *, CASE WHEN contains(text, ' [/INST]') OR contains(text, ' <</SYS>>') OR contains(text, ' </s>') OR contains(text, ' [/TURN]')
      OR contains(text, '\0') OR contains(text, '\1') OR contains(text, '\2')
    THEN replace(replace(replace(text, '\', '\0'), '[', '\1'), '<', '\2') ELSE text END AS body,
    CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 9 END AS marks
  FROM c),
q AS (
  SELECT *, CASE WHEN role IS NULL THEN 15 WHEN marks IS NULL
    THEN 24 + len(replace(replace(replace(role, '\', '\0'), '[', '\1'), '<', '\2')) ELSE marks END AS chars FROM p)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(len(body) + chars) AS BIGINT) AS formatted_chars
FROM q GROUP BY conv_id
"""

_RULE_ROWS = ", ".join(
    [f"('{h}', '{p}', '{v}', 1)" for h, p, v in RULES] + [f"('{h}', '/', 'block', 0)" for h in SPAM_HOSTS]
)

_OP10 = f"""
WITH r AS (
  SELECT row_number() OVER () AS row_no, page_id, md5(nullif(regexp_extract(coalesce(html, ''), '<body>(.*)</body>', 1, 's'), '')) AS body,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p0 AS (
  SELECT row_no, page_id, body, {_LOWERED.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
p AS (
  SELECT *, regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '[.]+$', '')
    || regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/$', '') AS name FROM p0),
mirrors AS (
  SELECT DISTINCT name FROM (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p WHERE body IS NOT NULL)
  WHERE page_id > first_id AND name <> ''),
rules AS (SELECT * FROM (VALUES {_RULE_ROWS}) AS x(h, q, v, is_rule)),
best AS (
  SELECT row_no, arg_max(struct_pack(rule := h || q, verdict := v, is_rule := is_rule), is_rule * 100000 + len(h || q)) AS b
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY row_no)
SELECT page_id, host, path, CASE WHEN b.is_rule = 1 THEN b.rule END AS rule,
  coalesce(b.verdict, CASE WHEN host <> '' AND mirrors.name IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN best USING (row_no) LEFT JOIN mirrors USING (name)
"""

# CRC-32 of decimal numbers, from its table of bytes.
_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT), 1, 2, 3, 4, 5, 6, 7, 8],
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i)))"""


def _crc(number: str) -> str:
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


_OP11 = f"""
WITH {_CRC_TABLE},
o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
l AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS x FROM o GROUP BY conv_id),
c AS (SELECT conv_id, x, conv_id - conv_id % 20 AS base, {_crc("conv_id")} % 4 AS h FROM l, crc_table),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.x[1:h], []), c.x[h + 1:]) AS x FROM c LEFT JOIN l AS b ON b.conv_id = c.base),
n AS (SELECT conv_id, d, x[1:d] AS k, len(x) = d AS ends FROM (SELECT *, unnest(range(len(x) + 1)) AS d FROM r)),
g AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(k[d].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM n GROUP BY d, k),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL),
tops AS (
  SELECT up AS d, k[1:up] AS k, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT g.*, n_children, unnest(range(d + 1)) AS up FROM g LEFT JOIN kids USING (d, k)) GROUP BY ALL)
SELECT g.conv_id, g.d AS depth, p.conv_id AS parent_conv_id, g.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(g.ends) AS ends_sha256
FROM g JOIN tops USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN g AS p ON p.d = g.d - 1 AND p.k = g.k[1:g.d - 1]
"""

# Periods are the distances of equal five-word groups that come as often as a run needs.
_OP13 = f"""
WITH {_CRC_TABLE},
d0 AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
d1 AS (SELECT *, CAST(len(w) AS BIGINT) AS n, {_crc("doc_id")} AS h FROM d0, crc_table),
d2 AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM d1),
d3 AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM d2),
d AS (
  SELECT row_no, doc_id, n, list_transform(range(n), lambda i: w[CASE WHEN i < a OR a IS NULL THEN i ELSE a + (i - a) % p END + 1]) AS x
  FROM d3),
u AS (SELECT row_no, n, unnest(range(n)) AS i, unnest(x) AS v FROM d),
five AS (
  SELECT row_no, n, i, concat_ws(' ', v, lead(v) OVER w, lead(v, 2) OVER w, lead(v, 3) OVER w, lead(v, 4) OVER w) AS k
  FROM u WINDOW w AS (PARTITION BY row_no ORDER BY i) QUALIFY lead(v, 4) OVER w IS NOT NULL),
tried AS (
  SELECT row_no, q FROM (
    SELECT a.row_no, b.i - a.i AS q FROM five AS a JOIN five AS b ON a.row_no = b.row_no AND a.k = b.k AND b.i > a.i
    WHERE 4 * (b.i - a.i) <= a.n)
  GROUP BY row_no, q HAVING count(*) >= greatest(6, 4 * q) - q - 4),
same AS (
  SELECT a.row_no, q, a.i, a.i - row_number() OVER (PARTITION BY a.row_no, q ORDER BY a.i) AS island
  FROM tried JOIN u AS a USING (row_no) JOIN u AS b ON a.row_no = b.row_no AND b.i = a.i + q AND a.v = b.v),
runs AS (
  SELECT row_no, s, m, min(q) AS q
  FROM (SELECT row_no, q, min(i) AS s, count(*) + q AS m FROM same GROUP BY row_no, q, island) WHERE m >= greatest(6, 4 * q)
  GROUP BY row_no, s, m),
per AS (
  SELECT row_no, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    arg_min(struct_pack(s := s, m := m, q := q), [-m, s, q]) AS best
  FROM runs GROUP BY row_no),
gone AS (SELECT DISTINCT row_no, unnest(range(s + q, s + m)) AS i FROM runs),
kept AS (
  SELECT row_no, string_agg(v, ' ' ORDER BY i) AS text FROM u JOIN (SELECT DISTINCT row_no FROM runs) USING (row_no)
    ANTI JOIN gone USING (row_no, i) GROUP BY row_no)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.m AS length, best.q AS period,
  1000 * best.m // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(CASE WHEN n_runs > 0 THEN kept.text ELSE array_to_string(x, ' ') END) AS collapsed_sha256
FROM d LEFT JOIN per USING (row_no) LEFT JOIN kept USING (row_no)
"""

ORACLES = {
    "op1_decontaminate": _OP1,
    "op2_licenses": _OP2,
    "op4_mixing": _OP4,
    "op6_chat": _OP6,
    "op10_urls": _OP10,
    "op11_trie": _OP11,
    "op13_periods": _OP13,
}
