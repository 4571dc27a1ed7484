"""DuckDB SQL of the mixing, spelling and repair queries."""

from __future__ import annotations

CURRICULUM = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
n AS (
  SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) - 1 AS nth FROM d),
h AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), size, nth)), 1, 15))::BIGINT
           AS spot
  FROM n),
s AS (
  SELECT *, (ARRAY[5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[
              (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
filled AS (
  SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS remaining, sum(weight) AS weights,
         1.5::DOUBLE * sum(source_size)::DOUBLE AS budget FROM s
  UNION
  SELECT any_value(budget) - coalesce(sum(CASE WHEN over THEN 2 * source_size END), 0)::DOUBLE,
         sum(CASE WHEN NOT over THEN weight END), any_value(budget)
  FROM (SELECT f.*, s.*, f.remaining * s.weight / f.weights > 2 * s.source_size AS over FROM filled f, s)
  GROUP BY remaining, weights),
fixed AS (SELECT * FROM filled ORDER BY weights LIMIT 1),
t AS (
  SELECT s.source, source_size, weight,
         least(fixed.remaining * weight / fixed.weights, 2.0 * source_size) AS target FROM s, fixed),
p AS (
  SELECT h.doc_id, h.size, t.source_size, t.target, t.weight,
         coalesce(sum(h.size) OVER (PARTITION BY h.source ORDER BY h.spot, h.doc_id, h.size, h.nth
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         floor(t.target + 0.5) AS quota
  FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source),
w AS (
  SELECT *, greatest(least(size, quota - before), 0)::BIGINT AS first,
         greatest(least(size, quota - before - source_size), 0)::BIGINT AS second FROM p),
y AS (
  SELECT *, CASE WHEN first > 0 THEN (before + first / 2) / target END AS part FROM w)
SELECT doc_id, size, source_size, target, first + second AS taken,
       CASE weight
         WHEN 1 THEN part
         WHEN 5 THEN 2 * (part * 5) / (6 + sqrt(36 - 4 * (part * 5)))
         ELSE CASE WHEN part * 2 < 0.75
                   THEN 2 * (part * 2) / (1 + sqrt(1 + 4 * (part * 2)))
                   ELSE 0.5 + 2 * (part * 2 - 0.75) / (2 + sqrt(4 + 4 * (part * 2 - 0.75))) END
       END AS first_position
FROM y
"""

#: crc32 by its table, which a rule makes; {bytes} is a list of the bytes.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bytes}),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"""
_TABLE = """
tab AS (SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i)))"""

SPELLING = r"""
WITH RECURSIVE""" + _TABLE + r""",
r AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')) AS run FROM documents)
  GROUP BY ALL),
x AS (
  SELECT run, k, hex(encode(concat(doc_id, ':', run))) AS hex FROM r),
c AS (
  SELECT run, k, """ + _CRC.format(
      bytes="list_transform(range(1, length(hex), 2), lambda i: ('0x' || substr(hex, i, 2))::BIGINT)") + r""" AS h
  FROM x, tab),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
                  || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k FROM c)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
-- What is left of a word without one of its letters.
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near,
         first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
f AS (
  SELECT w.word, CASE WHEN other_n >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, coalesce(form, word) AS goal, 1 AS steps FROM f
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN f ON c.goal = f.word WHERE f.form IS NOT NULL
    AND c.goal <> c.word)
SELECT f.word, form, r.goal AS root, n, n_near, form_n
FROM f JOIN (SELECT word, arg_max(goal, steps) AS goal FROM chain GROUP BY word) r ON f.word = r.word
"""

REPAIR = r"""
WITH RECURSIVE""" + _TABLE + r""",
o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS name FROM conversations),
k AS (
  SELECT *, """ + _CRC.format(
      bytes="list_transform(range(1, length(name) + 1), lambda i: ord(substr(name, i, 1))::BIGINT)") + r""" % 20 AS kind
  FROM o, tab),
g AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM k WHERE kind <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM g),
m AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault
  FROM n),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         max(i) AS turns
  FROM m GROUP BY conv_id),
-- Cheapest (cost, audit) after i turns at the start, behind s, behind u, behind whole pairs.
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS b, {'c': 1000000000::BIGINT, 'a': ''} AS s,
         {'c': 1000000000::BIGINT, 'a': ''} AS u, {'c': 1000000000::BIGINT, 'a': ''} AS p FROM counts
  UNION ALL
  SELECT w.conv_id, m.i,
    {'c': b.c + 3, 'a': b.a || 'D'},
    list_min([{'c': s.c + 3, 'a': s.a || 'D'},
              {'c': CASE WHEN may AND initial = 's' THEN b.c + t ELSE 1000000000 END, 'a': b.a || 'K'}]),
    list_min([{'c': u.c + 3, 'a': u.a || 'D'}] || CASE WHEN NOT may THEN [] ELSE
      list_transform([b, s, p], lambda x: {'c': x.c + t + 2 * (initial <> 'u')::INT, 'a': x.a || way}) ||
      [{'c': u.c + 2 + t + 2 * (initial <> 'u')::INT, 'a': u.a || 'I' || way}] END),
    list_min([{'c': p.c + 3, 'a': p.a || 'D'}] || CASE WHEN NOT may THEN [] ELSE
      list_transform([b, s, p], lambda x: {'c': x.c + 2 + t + 2 * (initial <> 'a')::INT, 'a': x.a || 'I' || yaw}) ||
      [{'c': u.c + t + 2 * (initial <> 'a')::INT, 'a': u.a || yaw}] END)
  FROM walk w JOIN (
    SELECT conv_id AS conv, i, initial, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS may,
           (coalesce(fault, '') = 'truncated')::INT AS t, CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END AS way,
           CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END AS yaw FROM m) m
  ON w.conv_id IS NOT DISTINCT FROM m.conv AND m.i = w.i + 1),
done AS (
  SELECT w.conv_id, list_min([b, p, {'c': u.c + 2, 'a': u.a || 'I'}, {'c': s.c + 4, 'a': s.a || 'II'}]) AS z
  FROM walk w JOIN counts q ON w.conv_id IS NOT DISTINCT FROM q.conv_id AND w.i = q.turns),
letters AS (
  SELECT conv_id, j, substr(z.a, j, 1) AS edit, length(replace(z.a, 'D', '')) AS stay,
         length(replace(substr(z.a, 1, j), 'I', '')) AS i, length(replace(substr(z.a, 1, j), 'D', '')) AS q
  FROM (SELECT *, unnest(range(1, length(z.a) + 1)) AS j FROM done)),
whole AS (
  SELECT l.conv_id, sha256(string_agg(concat(
           CASE WHEN edit = 'K' THEN m.role WHEN (q + stay) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':',
           CASE WHEN edit = 'I' THEN '' ELSE m.text END), chr(10) ORDER BY j)) AS digest
  FROM letters l LEFT JOIN m ON l.conv_id IS NOT DISTINCT FROM m.conv_id AND l.i = m.i AND edit <> 'I'
  WHERE edit <> 'D' GROUP BY l.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(z.c, 0) AS cost,
       coalesce(z.a, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON e.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN whole v ON e.conv_id IS NOT DISTINCT FROM v.conv_id
"""
