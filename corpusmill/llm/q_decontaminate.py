"""Query of benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import read
from corpusmill.llm.decontaminate import decontaminate


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

SQL = {"op1_decontaminate": f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
sized AS (SELECT item, ws, least(13, len(ws)) AS n FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS w
            FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
grams AS (SELECT r, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS w
       FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, lengths WHERE len(ws) >= n)),
hits AS (SELECT r, i, n, item FROM grams JOIN windows USING (n, w)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
              FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(ws), 0) AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""}

QUERIES = {"op1_decontaminate": op1_decontaminate}
