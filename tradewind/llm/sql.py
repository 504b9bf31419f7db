"""DuckDB SQL for those registered queries that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 10))::BIGINT AS h,
         ('0x' || substr(md5(coalesce(text, '')), 1, 10))::BIGINT AS mark,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
weighed AS (
  SELECT source, s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM totals),
-- Sources by how soon a rising rate meets their cap; before each, what is left if those earlier are capped.
lined AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * s / w, source NULLS LAST) AS k FROM weighed),
rates AS (
  SELECT *, (SELECT sum(s) FROM weighed) - coalesce(sum(3 * s) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM lined),
level AS (SELECT left_over, w_left FROM rates WHERE w * left_over <= 3 * s * w_left ORDER BY k LIMIT 1),
targets AS (
  SELECT r.source, r.s,
         CASE WHEN l.w_left IS NULL OR r.w * l.left_over > 3 * r.s * l.w_left THEN CAST(3 * r.s AS DOUBLE)
              ELSE CAST(r.w * l.left_over AS DOUBLE) / CAST(l.w_left AS DOUBLE) END AS target
  FROM rates r LEFT JOIN level l ON true),
passes AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS q FROM targets),
runs AS (
  SELECT d.doc_id, d.size, p.s, p.target, p.q, p.target - p.q * p.s AS rest, d.source, d.h,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.mark, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         d.size AS cell
  FROM sized d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
       CAST(size * (q + CASE WHEN rest > 0 AND (upto < rest OR upto - cell < rest AND upto - rest < rest - (upto - cell))
                             THEN 1 ELSE 0 END) AS BIGINT) AS taken, source
FROM runs
"""

TOP_K = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))), 0) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec::DOUBLE[], c.vec::DOUBLE[]) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

# Lower case for A to Z only, words split at the six white spaces.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

def _near_duplicates(width: int, more: str = "") -> str:
    return f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i : i + {width - 1}], ' '))) END AS s
  FROM texts),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS first, min(r) AS c, len(any_value(s)) AS n FROM sets
            WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY list_sort(s)),
members AS (SELECT c, first, n, unnest(s) AS shingle FROM classes),
links AS (
  SELECT a.first AS u, b.first AS v FROM members a JOIN members b ON a.shingle = b.shingle AND a.c < b.c
  GROUP BY a.c, b.c, a.first, b.first, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
ties AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT first AS a, first AS b FROM classes UNION SELECT r.a, t.v FROM reach r JOIN ties t ON r.b = t.u),
least AS (SELECT a, min(b) AS component FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       CASE WHEN s.doc_id IS NULL THEN NULL WHEN len(s.s) = 0 THEN s.doc_id ELSE l.component END AS component_id{more}
FROM sets s LEFT JOIN classes c ON list_sort(s.s) = c.s LEFT JOIN least l ON c.first = l.a
"""


NEAR_DUPLICATES = _near_duplicates(5)

# A row without a doc_id is no copy of another.
MINHASH = _near_duplicates(2, ", coalesce(s.doc_id = component_id, true) AS kept")

# Windows are strings of 200 hex digits; a removed byte is one that a repeated window covers.
REPEATS = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS d, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (SELECT r, d, unnest(range(len(x) // 2 - 99)) AS k, x FROM texts WHERE len(x) >= 200),
marked AS (SELECT r, d, k, md5_number(substr(x, 2 * k + 1, 200)) AS m FROM windows),
firsts AS (SELECT m, min((d, k)) AS first FROM marked GROUP BY m HAVING count(*) > 1),
starts AS (SELECT r, k FROM marked JOIN firsts USING (m) WHERE (d, k) > first),
stepped AS (SELECT r, k, lag(k) OVER (PARTITION BY r ORDER BY k) AS before FROM starts),
islands AS (SELECT r, k, sum(CASE WHEN before IS NULL OR k > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY k) AS i FROM stepped),
spans AS (SELECT r, min(k) AS a, max(k) + 100 AS b FROM islands GROUP BY r, i),
pieces AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS kept_from FROM spans),
cut AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(a || ':' || b, ',' ORDER BY a) AS spans, max(b) AS last,
         string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept
  FROM pieces JOIN texts USING (r) GROUP BY r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, coalesce(spans, '') AS spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE kept || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)
"""

def _crc32(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes: eight steps a byte over the reflected polynomial."""
    byte = "CAST('0x' || substr(hex(encode({0})), 2 * i - 1, 2) AS BIGINT)".format(text)
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))"
    each = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {byte})"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {each}), lambda c, b: {step}), 4294967295)"


# A node is the digest of the digests of its turns.
CONVERSATION_TREE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT conv_id, list((md5(len(role) || ':' || role || text), CAST(octet_length(encode(text)) AS BIGINT))
                       ORDER BY turn NULLS FIRST, md5(len(role) || ':' || role || text)) AS own
  FROM turns GROUP BY conv_id),
plans AS (SELECT *, CAST({_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS INTEGER) AS h, conv_id - conv_id % 5 AS base FROM lists),
rebuilt AS (
  SELECT p.conv_id, list_concat(coalesce(b.own[: p.h], []), p.own[p.h + 1 :]) AS steps
  FROM plans p LEFT JOIN lists b ON b.conv_id = p.base),
prefixes AS (
  SELECT conv_id, unnest(range(len(steps) + 1)) AS depth, steps FROM rebuilt),
named AS (
  SELECT conv_id, depth, len(steps) AS n_turns, CASE WHEN depth > 0 THEN steps[depth][2] ELSE 0 END AS size,
         md5(array_to_string(list_transform(steps[: depth], lambda x: x[1]), ',')) AS node,
         CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(steps[: depth - 1], lambda x: x[1]), ',')) END AS up
  FROM prefixes),
nodes AS (
  SELECT node, any_value(up) AS up, any_value(depth) AS depth, min(conv_id) AS first, count(*) AS n, (count(*) - 1) * any_value(size) AS saved,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = n_turns), '') AS ends
  FROM named GROUP BY node),
children AS (SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
whole AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)),
-- Each node below each node on the path of its smallest member.
below AS (
  SELECT a.node, w.saved, CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END AS leaf
  FROM whole w JOIN named a ON a.conv_id = w.first AND a.depth <= w.depth),
sums AS (SELECT node, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM below GROUP BY node)
SELECT w.first AS conv_id, w.depth, p.first AS parent_conv_id, w.n AS n_convs, w.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM whole w JOIN sums s USING (node) LEFT JOIN nodes p ON w.up = p.node
"""


# Words of ASCII digits and lower-case letters and of whatever is not ASCII.
_RUNS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

RESAMPLING = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, md5(coalesce(text, '')) AS mark, {_RUNS} AS w FROM documents),
items AS (SELECT unnest({_RUNS}) AS word FROM benchmark),
words AS (SELECT r, unnest(w) AS word FROM docs),
buckets AS (
  SELECT word, CAST({_crc32("word")} % 10000 AS BIGINT) AS bucket FROM (SELECT word FROM words UNION SELECT word FROM items)),
corpus AS (SELECT bucket, count(*) AS s FROM words JOIN buckets USING (word) GROUP BY bucket),
wanted AS (SELECT bucket, count(*) AS t FROM items JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM words) AS big_s, (SELECT count(*) FROM items) AS big_t),
gains AS (
  SELECT c.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (big_s + 10000)::DOUBLE
                                        / ((s + 1)::DOUBLE * (big_t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM corpus c LEFT JOIN wanted USING (bucket) CROSS JOIN totals),
weights AS (
  SELECT r, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n FROM words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, mark, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
         CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[:8] AS BIGINT) AS h
  FROM docs LEFT JOIN weights USING (r)),
results AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
lined AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, mark) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS many
  FROM results)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN n_features >= 20 AND place <= 10 * many // 100 THEN place END AS rank
FROM lined
"""
