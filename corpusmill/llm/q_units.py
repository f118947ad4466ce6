"""Query of substring deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import read
from corpusmill.llm.units import drop_repeats


#: A document repeats a passage if units in a row of so many words were removed: of a passage of over
#: 50 words, the sentences at its ends may be joined to others.
PASSAGE = 25


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines and sentences that an earlier one has."""
    found = drop_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), unit="sentence")
    ranges = F.transform("removed", lambda r: F.concat_ws("-", r["first"], r["end"]))
    return found.select("doc_id", (F.col("longest") >= PASSAGE).alias("repeats_passage"), "n_removed", "longest",
                        F.array_join(ranges, ",").alias("removed"), "text")


SQL = {"op2_line_dedup": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, text, string_split(regexp_replace(text, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS ls FROM documents),
units AS (
  SELECT r, doc_id, text, i, ls[i] AS unit, regexp_extract_all(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM docs)),
placed AS (
  SELECT *, CAST(coalesce(sum(length(unit) + 1) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
  FROM units),
ranked AS (
  SELECT *, doc_id IS NOT NULL AND len(ws) >= 1
            AND dense_rank() OVER (PARTITION BY len(ws) >= 1 AND doc_id IS NOT NULL, array_to_string(ws, ' ') ORDER BY doc_id, i) > 1 AS gone FROM placed),
stretches AS (
  SELECT *, count(*) FILTER (WHERE NOT gone AND len(ws) > 0) OVER (PARTITION BY r ORDER BY i) AS stretch FROM ranked),
longest AS (
  SELECT r, max(n) AS longest FROM (SELECT r, sum(len(ws)) FILTER (WHERE gone) AS n FROM stretches GROUP BY r, stretch) GROUP BY r),
cut AS (
  SELECT r, string_agg(CASE WHEN i = 1 THEN chr(10) ELSE substr(text, first, 1) END || unit, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept,
         count(*) FILTER (WHERE gone) AS n, string_agg(first || '-' || (first + length(unit)), ',' ORDER BY i) FILTER (WHERE gone) AS removed
  FROM ranked GROUP BY r)
SELECT doc_id, coalesce(longest, 0) >= 25 AS repeats_passage, coalesce(n, 0) AS n_removed, CAST(coalesce(longest, 0) AS BIGINT) AS longest,
       coalesce(removed, '') AS removed, CASE WHEN text IS NOT NULL THEN coalesce(substr(kept, 2), '') END AS text
FROM docs LEFT JOIN cut USING (r) LEFT JOIN longest USING (r)
"""}
QUERIES = {"op2_line_dedup": op2_line_dedup}
