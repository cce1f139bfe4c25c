"""SQL of the operators that SQL can express, for another engine to run on the
same tables."""

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

LINE_DEDUP = r"""
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
win AS (SELECT doc_id, pos, lines[pos] AS a, lines[pos + 1] AS b, lines[pos + 2] AS c
        FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS pos FROM cut WHERE len(lines) >= 3)),
later AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth FROM win),
lost AS (SELECT doc_id, list(DISTINCT line) AS gone
         FROM (SELECT doc_id, unnest(range(pos, pos + 3)) AS line FROM later WHERE nth > 1) GROUP BY doc_id)
SELECT c.doc_id,
       CASE WHEN gone IS NULL THEN text
            ELSE coalesce(array_to_string(list_transform(
                 list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)), lambda i: lines[i]), chr(10)), '') END AS text,
       CAST(CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed
FROM cut c LEFT JOIN lost l ON c.doc_id = l.doc_id
"""

MIX_SOURCES = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(greatest(len({words}), 1) AS BIGINT) AS size FROM documents),
share AS (SELECT source, CAST(sum(size) AS BIGINT) AS tokens FROM sized GROUP BY source),
total AS (SELECT CAST(sum(tokens) AS BIGINT) AS t, count(*) AS s, list(tokens) AS ts FROM share),
plain AS (SELECT h + 0.5 * (ln(s) - h) AS target FROM (
  SELECT s, -list_sum(list_transform(ts, lambda x: x / t::DOUBLE * ln(x / t::DOUBLE))) AS h FROM total)),
steps(lo_e, hi_e, lo_r, hi_r) AS (
  SELECT 0, 1048576, -1, 1048576
  UNION ALL
  SELECT CASE WHEN hi_e - lo_e > 1 AND flat THEN me ELSE lo_e END, CASE WHEN hi_e - lo_e > 1 AND NOT flat THEN me ELSE hi_e END,
         CASE WHEN hi_r - lo_r > 1 AND NOT calm THEN mr ELSE lo_r END, CASE WHEN hi_r - lo_r > 1 AND calm THEN mr ELSE hi_r END
  FROM (SELECT *, ln(ze) - zxe / ze >= target AS flat, top / zr * t <= 4.0 AS calm FROM (
    SELECT *, list_sum(list_transform(ts, lambda x: exp(me / 1048576.0::DOUBLE * ln(x / t::DOUBLE)))) AS ze,
           list_sum(list_transform(ts, lambda x: exp(me / 1048576.0::DOUBLE * ln(x / t::DOUBLE)) * (me / 1048576.0::DOUBLE * ln(x / t::DOUBLE)))) AS zxe,
           list_sum(list_transform(ts, lambda x: exp(mr / 1048576.0::DOUBLE * ln(x / t::DOUBLE)))) AS zr,
           list_max(list_transform(ts, lambda x: exp(mr / 1048576.0::DOUBLE * ln(x / t::DOUBLE)) / x)) AS top
    FROM (SELECT *, (lo_e + hi_e) // 2 AS me, (lo_r + hi_r + 2) // 2 - 1 AS mr FROM steps, total, plain
          WHERE hi_e - lo_e > 1 OR hi_r - lo_r > 1)))),
best AS (SELECT greatest(max(lo_e), min(hi_r)) / 1048576.0::DOUBLE AS e FROM steps),
power AS (SELECT source, tokens, exp(e * ln(tokens / t::DOUBLE)) AS p, t FROM share, total, best),
plan AS (SELECT source, tokens, t, p / (SELECT sum(p) FROM power) AS weight,
                CAST(floor(p / (SELECT sum(p) FROM power) * t) AS BIGINT) AS part FROM power),
spread AS (SELECT d.doc_id, d.source, d.size, p.weight, p.part, p.tokens, p.t, unnest(range(0, CAST(ceil(part / tokens) AS BIGINT))) AS epoch
           FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
placed AS (SELECT *, epoch * tokens + coalesce(sum(size) OVER (PARTITION BY source, epoch
             ORDER BY md5('11|' || epoch || '|' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM spread),
drawn AS (SELECT *, CAST(floor(start * greatest(1, ceil(t / 65536)) / part) AS BIGINT) AS block FROM placed WHERE start < part)
SELECT doc_id, source, size AS n_tokens, epoch, CAST(start AS BIGINT) AS start, block,
       row_number() OVER (PARTITION BY block ORDER BY md5('12|' || epoch || '|' || doc_id), doc_id, epoch) - 1 AS slot,
       round(weight * 1e6) / 1e6 AS weight
FROM drawn
""".replace("{words}", _WORDS.replace("{text}", "coalesce(text, '')"))

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, {words} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY 1, 2
""".replace("{words}", _WORDS.replace(
    "{text}", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, {words} AS ws FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50)),
earliest AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN earliest USING (h) WHERE lo < doc_id),
each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""".replace("{words}", _WORDS.replace("{text}", "coalesce(text, '')"))

#: The checksum of an id's decimal form is taken bit by bit (fixed value: the
#: reversed CRC-32 polynomial 0xEDB88320 = 3988292384).
CONVERSATION_TRIE = r"""
WITH t AS (
  SELECT conv_id AS c, length(coalesce(text, '')) AS chars, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n, c - c % 100 AS base, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)) AS digits FROM t GROUP BY c),
h AS (SELECT c, n, base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, digits), lambda crc, b:
        list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) % 6 AS h FROM n),
r AS (SELECT h.c, b.pos, b.k, b.chars FROM h JOIN t b ON b.c = h.base AND b.pos < h.h
      UNION ALL
      SELECT h.c, t.pos - h.h + least(h.h, coalesce(b.n, 0)), t.k, t.chars FROM t JOIN h ON h.c = t.c AND t.pos >= h.h LEFT JOIN n b ON b.c = h.base),
s AS (SELECT h.c, coalesce(list(r.k ORDER BY r.pos) FILTER (WHERE r.k IS NOT NULL), []) AS ks,
             coalesce(list(r.chars ORDER BY r.pos) FILTER (WHERE r.k IS NOT NULL), []) AS cs FROM h LEFT JOIN r ON r.c = h.c GROUP BY h.c),
p AS (SELECT c, d, len(ks) AS size, coalesce(cs[d], 0) AS chars, md5(array_to_string(ks[1:d], '|')) AS node,
             CASE WHEN d > 0 THEN md5(array_to_string(ks[1:d - 1], '|')) END AS up
      FROM (SELECT c, ks, cs, unnest(range(0, len(ks) + 1)) AS d FROM s)),
g AS (SELECT node, d AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = size), '')) AS ends_sha256 FROM p GROUP BY node, d),
kids AS (SELECT up, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY up),
v AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN kids ON kids.up = g.node),
sums AS (SELECT p.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.chars) AS saved_tokens
         FROM v JOIN p ON p.c = v.conv_id AND p.d <= v.depth GROUP BY p.node)
SELECT CAST(v.conv_id AS BIGINT) AS conv_id, CAST(v.depth AS BIGINT) AS depth, CAST(u.conv_id AS BIGINT) AS parent_conv_id,
       CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN sums ON sums.node = v.node LEFT JOIN g u ON u.node = v.up
"""
