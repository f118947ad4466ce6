"""Query of spelling variant grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import read
from corpusmill.llm.spelling import variants, words


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, its commonest near form and the root of its forms."""
    return variants(words(read(spark, sf_dir, "documents")))


SQL: dict[str, str] = {}
QUERIES = {"op13_spelling": op13_spelling}
