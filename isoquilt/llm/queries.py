"""One query for each operator, over its whole table, with production parameters."""

from isoquilt.llm import archive, bpe, language, lines, mixing, pii, simhash, url_filter, vafile, vptree
from isoquilt.llm.registry import query, table

# The listed urls of the filter.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

_URL_SQL = r"""
WITH rules(rule, r_host, r_path, r_verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
parts AS (
  SELECT page_id, row_number() OVER () AS n,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
fitting AS (
  SELECT n, max_by(rule, length(rule)) AS rule, max_by(r_verdict, length(rule)) AS verdict
  FROM parts JOIN rules
    ON (host = r_host OR suffix(host, '.' || r_host)) AND prefix(path, r_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fitting USING (n)
"""

_ARCHIVE_SQL = """
WITH hashed AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex
  FROM pages),
firsts AS (SELECT hex, min(page_id) AS first_page FROM hashed GROUP BY hex)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    ((('0x' || substr(hex, CAST(i // 4 AS INTEGER) * 5 + 1, 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1
    AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id > first_page OR (page_id IS NULL AND first_page IS NOT NULL) THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN page_id > first_page OR (page_id IS NULL AND first_page IS NOT NULL) THEN first_page END AS refers_to
FROM hashed JOIN firsts USING (hex)
"""

_TOP_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT vec_id, e, list_transform(e, lambda x: floor(1024 * x)) AS v FROM rows),
scored AS (
  SELECT q.vec_id AS query_id, q.e AS query, c.vec_id,
    CAST(CASE WHEN len(q.v) = 0 THEN 0 ELSE list_inner_product(q.v, c.v) END AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND len(q.v) = len(c.v) AND (c.vec_id <> q.vec_id OR c.e <> q.e)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op1_lines")
def _op1(spark, sf_dir):
    return lines.report(table(spark, sf_dir, "documents"))


@query("op2_pii")
def _op2(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query("op3_mixing")
def _op3(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op4_language")
def _op4(spark, sf_dir):
    return language.predictions(table(spark, sf_dir, "documents"))


@query("op5_url_filter", _URL_SQL)
def _op5(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.listed_entries(spark, URL_RULES))


@query("op6_vptree")
def _op6(spark, sf_dir):
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


@query("op7_bpe")
def _op7(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"))


@query("op8_simhash")
def _op8(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_vafile", _TOP_SQL)
def _op9(spark, sf_dir):
    return vafile.best(table(spark, sf_dir, "embeddings"))


@query("op10_archive", _ARCHIVE_SQL)
def _op10(spark, sf_dir):
    return archive.archived(table(spark, sf_dir, "pages"))
