"""Query of WARC archives and their merged index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import read
from corpusmill.llm.warc import archive_and_index


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back through the merged index."""
    index = archive_and_index(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = {"op6_warc_index": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first, CAST(unhex(sha1(payload)) AS BIT)::VARCHAR AS bits FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT)
           + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT), 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""}
QUERIES = {"op6_warc_index": op6_warc_index}
