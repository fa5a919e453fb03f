"""Queries of the operators on conversations, phrases and repeated passages."""

from isoquilt.llm import passages, phrases, trie
from isoquilt.llm.registry import query, table

_TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    left(sha256(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'d': digest, 'b': octet_length(encode(text))} ORDER BY turn NULLS FIRST, digest) AS s FROM turns GROUP BY conv_id),
checksums AS (
  SELECT conv_id, s, conv_id - conv_id % 5 AS head, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda state, c: list_reduce(list_concat([xor(state, c)], CAST(range(8) AS BIGINT[])),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 9 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(o.s[1:CAST(h AS INTEGER)], []), c.s[CAST(h AS INTEGER) + 1:]) AS s
  FROM checksums c LEFT JOIN own o ON o.conv_id = c.head),
steps AS (
  SELECT conv_id, len(s) AS turns, d AS depth, sha256(array_to_string(list_transform(s[1:d], lambda x: x.d), '')) AS node,
    CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(s[1:d - 1], lambda x: x.d), '')) END AS parent,
    CASE WHEN d > 0 THEN s[d].b ELSE 0 END AS bytes
  FROM (SELECT conv_id, s, CAST(unnest(range(len(s) + 1)) AS INTEGER) AS d FROM rebuilt)),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
  FROM steps GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT a.node AS top, b.node FROM nodes n JOIN steps b ON b.node = n.node AND b.conv_id = n.conv_id
  JOIN steps a ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT top AS node, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM below JOIN nodes n ON n.node = below.node LEFT JOIN children c ON c.node = below.node GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN children c USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""


_PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, d, unnest(ps) AS piece, unnest(range(len(ps))) AS p
  FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
    FROM documents)),
worded AS (
  SELECT lang, d, p, unnest(w) AS w1, unnest(range(len(w))) AS i
  FROM (SELECT lang, d, p, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces)),
following AS (SELECT lang, w1, lead(w1) OVER piece_words AS w2, lead(w1, 2) OVER piece_words AS w3 FROM worded
  WINDOW piece_words AS (PARTITION BY d, p ORDER BY i)),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM following GROUP BY lang, w1
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM following WHERE w2 IS NOT NULL GROUP BY lang, w1 || ' ' || w2
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM following WHERE w3 IS NOT NULL
    GROUP BY lang, w1 || ' ' || w2 || ' ' || w3),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT p.lang, p.k, p.phrase, p.f, c,
    array_to_string(string_split(p.phrase, ' ')[1:c], ' ') AS first_part, array_to_string(string_split(p.phrase, ' ')[c + 1:], ' ') AS rest
  FROM grams p, (VALUES (1), (2)) AS places(c) WHERE p.k > c AND p.f >= 10),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.f, c.c, x.f AS l, y.f AS r,
    CAST(1000000 * CAST(c.f AS HUGEINT) * c.f // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.k = c.c AND x.phrase = first_part
  JOIN grams y ON y.lang = c.lang AND y.k = c.k - c.c AND y.phrase = rest),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS nth FROM scored),
longer AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, f, array_to_string(string_split(phrase, ' ')[1:2], ' ') AS part FROM grams WHERE k = 3 AND f >= 10
    UNION ALL SELECT lang, f, array_to_string(string_split(phrase, ' ')[2:3], ' ') FROM grams WHERE k = 3 AND f >= 10)
  GROUP BY lang, part),
kept AS (
  SELECT s.lang, s.phrase, s.f AS a, s.l, s.r, s.score FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase
  WHERE nth = 1 AND (k = 3 OR g.f IS NULL OR 100 * g.f < 50 * s.f)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_PASSAGES_SQL = r"""
WITH rows AS (SELECT doc_id, row_number() OVER () AS d, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
worded AS (SELECT doc_id, d, unnest(w) AS w, CAST(unnest(range(len(w))) AS BIGINT) AS i FROM rows),
windows AS (
  SELECT doc_id, d, i, CASE WHEN count(*) OVER ahead = 20 THEN md5(string_agg(w, ' ') OVER ahead) END AS h FROM worded
  WINDOW ahead AS (PARTITION BY d ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
firsts AS (SELECT h, min((doc_id, i)) AS first FROM windows WHERE h IS NOT NULL GROUP BY h),
judged AS (SELECT d, i, coalesce((doc_id, i) > first, false) AS again FROM windows LEFT JOIN firsts USING (h)),
covered AS (
  SELECT d, i, max(CAST(again AS INTEGER)) OVER (PARTITION BY d ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 1 AS gone FROM judged),
kept AS (
  SELECT d, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(w, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text
  FROM covered JOIN worded USING (d, i) GROUP BY d)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM rows LEFT JOIN kept USING (d)
"""


@query("op11_trie", _TRIE_SQL)
def _op11(spark, sf_dir):
    return trie.trie(table(spark, sf_dir, "conversations"))


@query("op12_phrases", _PHRASES_SQL)
def _op12(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_passages", _PASSAGES_SQL)
def _op13(spark, sf_dir):
    return passages.without_repeats(table(spark, sf_dir, "documents"))
