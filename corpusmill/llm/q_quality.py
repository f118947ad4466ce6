"""Query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import quality
from corpusmill.llm.common import read


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base statistics and verdict."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, model).drop("text")


#: The verdict is a sum of floating-point weights of hashed n-grams: no SQL; tests hold it against plain Python.
SQL: dict[str, str] = {}
QUERIES = {"op4_quality": op4_quality}
