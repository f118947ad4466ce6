"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import read
from corpusmill.llm.setjoin import jaccard_components


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and component."""
    found = jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr("id AS doc_id", "size AS n_shingles", "component AS component_id")


SQL = {"op10_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN []
                         WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' '))) END AS s
  FROM words),
kinds AS MATERIALIZED (SELECT min(r) AS k, list_sort(s) AS s, len(s) AS n, min(doc_id) AS first FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
tokens AS MATERIALIZED (SELECT k, n, hash(t) AS t FROM (SELECT k, n, unnest(s) AS t FROM kinds)),
shared AS MATERIALIZED (
  SELECT x.k AS a, y.k AS b, count(*) AS c, any_value(x.n) AS an, any_value(y.n) AS bn
  FROM tokens x JOIN tokens y ON x.t = y.t AND x.k < y.k AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n) GROUP BY x.k, y.k),
links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * c >= 75 * (an + bn - c)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT k AS src, k AS dst FROM kinds WHERE k IN (SELECT a FROM edges)
          UNION SELECT reach.src, edges.b FROM reach JOIN edges ON reach.dst = edges.a),
comp AS MATERIALIZED (SELECT src AS k, min(first) AS component_id FROM reach JOIN kinds ON kinds.k = reach.dst GROUP BY src)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles,
       CASE WHEN len(sets.s) = 0 THEN sets.doc_id ELSE coalesce(comp.component_id, kinds.first) END AS component_id
FROM sets LEFT JOIN kinds ON list_sort(sets.s) = kinds.s LEFT JOIN comp USING (k)
"""}
QUERIES = {"op10_jaccard_join": op10_jaccard_join}
