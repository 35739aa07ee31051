"""DuckDB SQL for the corpus queries that SQL can express on whole tables.

Each is the contract read plainly: all words, all windows, all pairs of texts
that share an n-gram.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS g
  FROM w WHERE len(w) > 0),
sets AS (SELECT g, min(doc_id) AS first_id, count(*) AS copies, len(g) AS n FROM grams GROUP BY g),
one AS (SELECT first_id, copies, n, unnest(g) AS x FROM sets),
links AS (
  SELECT a.first_id AS a, b.first_id AS b, any_value(b.copies) AS copies
  FROM one a JOIN one b ON a.x = b.x AND a.first_id <> b.first_id
  GROUP BY a.first_id, b.first_id, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT first_id, first_id FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
class AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
linked AS (SELECT a, count(*) AS n, sum(copies) AS docs FROM links GROUP BY a)
SELECT w.doc_id, coalesce(s.first_id, w.doc_id) AS copy_of, CAST(coalesce(s.copies, 1) AS BIGINT) AS n_copies,
       CAST(coalesce(l.n, 0) AS BIGINT) AS n_text_links,
       CAST(coalesce(l.docs, 0) + coalesce(s.copies, 1) - 1 AS BIGINT) AS n_links, coalesce(c.class_id, w.doc_id) AS class_id
FROM w LEFT JOIN grams USING (doc_id) LEFT JOIN sets s ON s.g = grams.g
LEFT JOIN linked l ON l.a = s.first_id LEFT JOIN class c ON c.a = s.first_id
"""

OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
item AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(win) AS m FROM item),
doc AS (SELECT doc_id, i, m, w[i:i + m - 1] AS win FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, size)),
hit AS (SELECT DISTINCT doc_id, i, m, item_id FROM doc JOIN item USING (win)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS joined
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN names USING (doc_id)
"""

OP9 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
first AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps
         FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (k) WHERE least < doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, len(w) AS n, coalesce(len(ps), 0) AS m,
                CASE WHEN ps IS NULL THEN w ELSE list_where(w, list_transform(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i))) END AS k
         FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""

OP13 = r"""
WITH crc_table AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY n) AS crc
  FROM (SELECT unnest(range(256)) AS n)),
t AS (
  SELECT conv_id AS c, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'x': x, 'n': n} ORDER BY turn NULLS FIRST, x) AS l FROM t GROUP BY c),
h AS (
  SELECT c, l, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                               lambda a, b: xor(a // 256, crc[(xor(a, b) % 256) + 1])), 4294967295) % 4 AS h
  FROM o, crc_table),
conv AS (SELECT h.c, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN o b ON b.c = h.c - h.c % 20),
m AS (
  SELECT c, d, len(l) AS size, list_transform(l[1:d], lambda e: e.x) AS k, coalesce(l[d].n, 0) AS n
  FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM conv)),
node AS (
  SELECT k, d, k[1:d - 1] AS up, min(c) AS c, count(*) AS n_convs, any_value(n) AS n,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = size) AS ended
  FROM m GROUP BY k, d),
child AS (SELECT up AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY up),
below AS (SELECT DISTINCT a.k, b.k AS x FROM m a JOIN m b ON a.c = b.c AND b.d >= a.d),
total AS (
  SELECT below.k, count(*) FILTER (WHERE coalesce(n_children, 0) = 0) AS n_leaves, sum((n_convs - 1) * n) AS saved
  FROM below JOIN node ON node.k = below.x LEFT JOIN child ON child.k = below.x GROUP BY below.k)
SELECT node.c AS conv_id, node.d AS depth, p.c AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ended, '')) AS ends_sha256
FROM node JOIN total ON total.k = node.k LEFT JOIN child ON child.k = node.k LEFT JOIN node p ON p.k = node.up AND node.d > 0
"""

OP12 = """
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT *, row_number() OVER () AS n FROM e),
s AS (
  SELECT a.n AS an, a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.n <> b.n AND len(a.q) = len(b.q)),
p AS (SELECT *, row_number() OVER (PARTITION BY an ORDER BY score DESC, b NULLS LAST) AS k FROM s WHERE same),
w AS (
  SELECT p.an, p.k, p.a, p.b, p.score AS ps, s.b AS neg, s.score AS ns,
         row_number() OVER (PARTITION BY p.an, p.k ORDER BY s.score DESC, s.b NULLS LAST) AS rank
  FROM p JOIN s ON s.an = p.an AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score WHERE p.k <= 5)
SELECT a AS anchor_id, b AS positive_id, CAST(rank AS INTEGER) AS rank, neg AS negative_id, ps AS positive_score, ns AS negative_score FROM w WHERE rank <= 5
"""

# first the counts, then references by language (words by sums, classes by medians in thousandths), then distances
_CLASSES = [
    r"\x00-\x1F", r"\x20", r"#$%&*+/<=>@\[\\\]^_`{|}~\x7F", "0-9", "A-Z", "a-z", r"\x{80}-\x{BF}", r"\x{C0}-\x{23F}", r"\x{240}-\x{1FFF}",
    r"\x{2000}-\x{2FFF}", r"\x{3000}-\x{D7FF}", r"\x{E000}-\x{FFFF}", r"\x{10000}-\x{10FFFF}", r"!\"''(),\-.:;?",
]
OP11 = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, text IS NOT NULL AS has, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, {_WORDS.replace("text", "t")} AS plain,
             [{", ".join(f"length(t) - length(regexp_replace(t, '[{c}]', '', 'g'))" for c in _CLASSES)}] AS classes FROM d),
win AS (SELECT r, i, w[i:i + 2] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, k FROM win GROUP BY r, k HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (r, k)) GROUP BY r),
c AS (
  SELECT w.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS lines,
         len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS once,
         coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)),
b AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
train AS (SELECT * FROM b WHERE NOT base_failed AND lang IS NOT NULL AND has),
word AS MATERIALIZED (SELECT lang, x, count(*) AS n FROM (SELECT lang, unnest(plain) AS x FROM train) GROUP BY lang, x),
total AS (SELECT lang, sum(n) AS n FROM word GROUP BY lang),
common AS (SELECT DISTINCT x FROM (SELECT x, row_number() OVER (PARTITION BY lang ORDER BY n DESC, x) AS k FROM word) WHERE k <= 40),
wref AS (
  SELECT lang, x, CAST(coalesce(word.n, 0) AS DOUBLE) / total.n AS q FROM total CROSS JOIN common LEFT JOIN word USING (lang, x)
  UNION ALL
  SELECT lang, NULL, (total.n - coalesce(sum(word.n), 0)) / CAST(total.n AS DOUBLE) FROM total LEFT JOIN (SELECT * FROM word JOIN common USING (x)) word USING (lang) GROUP BY lang, total.n),
part AS (SELECT lang, k, (2000 * classes[k] + length(t)) // (2 * length(t)) AS v FROM train, range(1, {len(_CLASSES) + 1}) AS g(k) WHERE length(t) >= 200),
median AS (SELECT lang, k, quantile_disc(v, 0.5) AS v FROM part GROUP BY lang, k),
cref AS (SELECT lang, k, v / CAST(sum(v) OVER (PARTITION BY lang) AS DOUBLE) AS q FROM median),
wp AS MATERIALIZED (SELECT r, CASE WHEN common.x IS NULL THEN NULL ELSE o.x END AS x, count(*) AS n
       FROM (SELECT r, unnest(plain) AS x FROM b WHERE NOT base_failed AND len(plain) >= 50) o LEFT JOIN common USING (x) GROUP BY ALL),
wd AS (
  SELECT r, min(js) AS js FROM (
    SELECT r, lang, sum(p * log2(2 * p / (p + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END - q) + 1 AS js
    FROM (SELECT wp.r, wp.x, wp.n / CAST(len(plain) AS DOUBLE) AS p FROM wp JOIN b USING (r)) s JOIN wref ON s.x IS NOT DISTINCT FROM wref.x GROUP BY r, lang) GROUP BY r),
cd AS (
  SELECT r, min(js) AS js FROM (
    SELECT r, lang, sum(p * log2(2 * p / (p + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END - q) + 1 AS js
    FROM (SELECT r, k, classes[k] / CAST(length(t) AS DOUBLE) AS p FROM b, range(1, {len(_CLASSES) + 1}) AS g(k)
          WHERE NOT base_failed AND length(t) >= 200 AND classes[k] > 0) s JOIN cref USING (k) GROUP BY r, lang) GROUP BY r)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(lines - once AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(cd.js > 0 AND sqrt(cd.js / 2) > 0.15 + 2.2 / sqrt(length(t)), false)
         AND NOT coalesce(wd.js > 0 AND sqrt(wd.js / 2) > 0.335 + 0.7 / sqrt(len(plain)), false) AS kept,
       CASE WHEN cd.js IS NOT NULL THEN round(sqrt(greatest(cd.js, 0) / 2), 6) END AS class_distance,
       CASE WHEN wd.js IS NOT NULL THEN round(sqrt(greatest(wd.js, 0) / 2), 6) END AS word_distance
FROM b LEFT JOIN cd USING (r) LEFT JOIN wd USING (r)
"""
