"""Query of SimHash near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import read
from corpusmill.llm.simhash import simhash_components


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and class."""
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


SQL: dict[str, str] = {}
QUERIES = {"op12_simhash": op12_simhash}
