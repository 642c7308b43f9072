"""DuckDB SQL of the registered queries that SQL can express, written over the plain tables.

Token merging, hash-ordered sharding with CRC-32, fitted models, suffix arrays
and alignments have none; tests hold those against brute force.
"""

from __future__ import annotations

from popcorr.llm import mixture

_FINGERPRINT = """
SELECT *, list_transform(leaves, lambda p: sha256(p)) AS leaf FROM (
  SELECT *, string_split(regexp_replace(replace(body, chr(1), chr(1) || chr(2)), '([.!?] |\\n)', '\\1' || chr(1), 'g'), chr(1)) AS leaves
  FROM {0})"""

FINGERPRINTS = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS nx,
         lead(doc_id) OVER (ORDER BY doc_id) AS after, min(doc_id) OVER () AS first_id FROM documents),
e AS (SELECT doc_id, coalesce(after, first_id) AS next_id, length(t) AS n_chars, t,
             substring(t, 1, length(t) - length(t) // 2) || substring(nx, 1, length(t) // 2) AS edited FROM d),
bodies AS (SELECT doc_id, 0 AS kind, t AS body FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
a AS ({_FINGERPRINT.format('bodies')}),
b AS (SELECT *, list_filter(string_split(array_to_string(list_transform(leaves, lambda p: sha256(p) ||
             CASE WHEN ends_with(p, chr(10)) THEN ';' ELSE ',' END), ''), ';'), lambda x: x <> '') AS paragraphs FROM a),
c AS (SELECT *, list_transform(paragraphs, lambda p: sha256(p)) AS digests FROM b),
s AS (SELECT *, list_transform(list_filter(string_split(array_to_string(list_transform(digests, lambda x: x ||
             CASE WHEN substr(x, 64, 1) IN ('0', '8') THEN ';' ELSE ',' END), ''), ';'), lambda x: x <> ''), lambda x: sha256(x)) AS sections FROM c),
f AS (SELECT doc_id, kind, list_distinct(list_transform(leaf, lambda x: substr(x, 1, 8))) AS heads,
             sha256(array_to_string(sections, '.')) || ':' || array_to_string(list_transform(sections, lambda x: substr(x, 1, 8)), '.')
             || ':' || array_to_string(list_transform(leaf, lambda x: substr(x, 1, 8)), '.') AS fp FROM s)
SELECT e.doc_id, CAST(e.n_chars AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, o.fp AS fingerprint, x.fp AS edited_fingerprint,
       CASE WHEN o.fp = x.fp THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(o.heads, x.heads)) / (len(o.heads) + len(x.heads)) END AS near_edited,
       CASE WHEN o.fp = n.fp THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(o.heads, n.heads)) / (len(o.heads) + len(n.heads)) END AS near_next
FROM e JOIN f o ON o.doc_id = e.doc_id AND o.kind = 0 JOIN f x ON x.doc_id = e.doc_id AND x.kind = 1
JOIN f n ON n.doc_id = e.next_id AND n.kind = 0"""

_WEIGHT = "CAST(CASE " + " ".join(f"WHEN (i - 1) % {len(mixture.WEIGHTS)} = {k} THEN {w}" for k, w in enumerate(mixture.WEIGHTS)) + " END AS BIGINT)"

MIXING = f"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|{mixture.SEED}'), 1, 13) AS BIGINT)::DOUBLE + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u FROM documents),
p0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, count(*) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM sizes GROUP BY source),
p1 AS (SELECT *, {_WEIGHT} AS w, {mixture.CAP} * s AS cap FROM p0),
p2 AS (SELECT *, cap::DOUBLE / w AS ratio FROM p1),
p3 AS (SELECT *, row_number() OVER (ORDER BY ratio, i) AS k,
              ({mixture.TOTAL_SHARE}::DOUBLE * CAST(sum(s) OVER () AS BIGINT)
               - CAST(coalesce(sum(cap) OVER (ORDER BY ratio, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
              / CAST(sum(w) OVER (ORDER BY ratio, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level FROM p2),
t AS (SELECT level FROM p3 WHERE level <= ratio ORDER BY k LIMIT 1),
per0 AS (SELECT source, s, n, least(cap::DOUBLE, (SELECT level FROM t) * w) AS target FROM p3),
per AS (SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS base FROM per0),
r AS (SELECT z.doc_id, z.source, z.size, p.s, p.target, p.base, p.target - p.base * p.s AS rest,
             (z.u / (1 - z.u)) / sqrt(z.size / (p.s / p.n)) AS rank
      FROM sizes z JOIN per p ON z.source IS NOT DISTINCT FROM p.source),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank, doc_id) AS k FROM r WHERE size > 0),
walk AS (SELECT source, rest, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS got, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS BIGINT) AS size, false AS extra
         FROM (SELECT source, any_value(rest) AS rest FROM ranked GROUP BY source)
         UNION ALL
         SELECT w.source, w.rest, n.k, w.got + CASE WHEN n.size <= w.rest - w.got THEN n.size ELSE 0 END, n.doc_id, n.size, n.size <= w.rest - w.got
         FROM walk w JOIN ranked n ON n.source IS NOT DISTINCT FROM w.source AND n.k = w.k + 1),
chosen AS (SELECT * FROM walk WHERE k > 0),
gap AS (SELECT source, any_value(rest) - CAST(coalesce(sum(size) FILTER (extra), 0) AS BIGINT) AS gap FROM chosen GROUP BY source),
closing AS (SELECT doc_id FROM (
  SELECT c.doc_id, row_number() OVER (PARTITION BY c.source ORDER BY abs(g.gap - c.size), c.doc_id) AS k
  FROM chosen c JOIN gap g ON c.source IS NOT DISTINCT FROM g.source WHERE NOT c.extra AND abs(g.gap - c.size) < g.gap) WHERE k = 1)
SELECT r.doc_id, r.size, r.s AS source_size, r.target,
       CAST(r.size * (r.base + CASE WHEN c.extra OR r.doc_id IN (SELECT doc_id FROM closing) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r LEFT JOIN chosen c ON r.doc_id = c.doc_id"""

NGRAM_JOIN = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
      FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT reach.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.r) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id"""

FILTER_AUDIT = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
least AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
f AS (SELECT d.doc_id, d.part,
             (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * (length(d.t) - length(regexp_replace(d.t, '[A-Z]', '', 'g'))) > 10 * length(d.t) THEN 4 ELSE 0 END)
             + (CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 8 ELSE 0 END)
             + (CASE WHEN l.first_id < d.doc_id THEN 16 ELSE 0 END) AS bits
      FROM d JOIN least l ON l.t = d.t),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT f.part, f.bits, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic, count(*) AS n
      FROM f LEFT JOIN l ON l.doc_id = f.doc_id GROUP BY 1, 2, 3, 4),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT x AS filter_order, bit AS used FROM letters
      UNION ALL SELECT filter_order || x, used + bit FROM o JOIN letters ON (used & bit) = 0),
s AS (SELECT filter_order, k AS step, substr(filter_order, k, 1) AS letter, 1 << (ascii(substr(filter_order, k, 1)) - 65) AS bit,
             list_sum(list_transform(range(1, k), lambda j: 1 << (ascii(substr(filter_order, CAST(j AS INTEGER), 1)) - 65))) AS before
      FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS k FROM o WHERE used = 31)),
r AS (SELECT part, filter_order, step, letter,
             sum(CASE WHEN (bits & (bit | b)) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN (bits & bit) <> 0 AND (bits & b) = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN (bits & bit) <> 0 AND (bits & b) <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN (bits & bit) <> 0 AND (bits & b) = 0 AND good THEN n ELSE 0 END) AS good_lost,
             sum(CASE WHEN (bits & bit) <> 0 AND (bits & b) = 0 AND toxic THEN n ELSE 0 END) AS toxic_lost
      FROM c, (SELECT filter_order, step, letter, CAST(bit AS INTEGER) AS bit, CAST(coalesce(before, 0) AS INTEGER) AS b FROM s) GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""

SQL = {"op13_filter_audit": FILTER_AUDIT, "op3_fingerprints": FINGERPRINTS, "op6_mixing": MIXING, "op8_ngram_join": NGRAM_JOIN}
