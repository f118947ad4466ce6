"""Query of language-model scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.backoff import LEAST_PAIR, score
from corpusmill.llm.common import read


def op8_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by the counts of all documents; words of pairs that occur once back off."""
    return score(read(spark, sf_dir, "documents").select("doc_id", "text"), least_pair=LEAST_PAIR)


SQL = {"op8_backoff": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
pairs AS MATERIALIZED (
  SELECT r, w, coalesce(lag(w) OVER (PARTITION BY r ORDER BY i), '') AS v
  FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs)),
words AS MATERIALIZED (SELECT w, count(*) AS n FROM pairs GROUP BY w),
contexts AS MATERIALIZED (SELECT v, count(*) AS n FROM pairs GROUP BY v),
counted AS MATERIALIZED (SELECT v, w, count(*) AS n FROM pairs GROUP BY v, w),
scores AS MATERIALIZED (
  SELECT counted.v, counted.w, counted.n >= 2 AS pair,
         CASE WHEN counted.n >= 2 THEN ln(counted.n / contexts.n::DOUBLE) ELSE ln(0.4::DOUBLE * words.n / (SELECT sum(n) FROM words)::DOUBLE) END AS s
  FROM counted JOIN contexts USING (v) JOIN words USING (w)),
summed AS (SELECT r, avg(s) AS score, count(*) FILTER (WHERE pair) AS n_pairs FROM pairs JOIN scores USING (v, w) GROUP BY r)
SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_pairs, 0) AS n_pairs, round(score, 6) AS score
FROM docs LEFT JOIN summed USING (r)
"""}
QUERIES = {"op8_backoff": op8_backoff}
