"""Query of surrogate generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import read
from corpusmill.llm.surrogates import again, pseudonymise

#: The key of the registered query; a user passes a secret of their own.
KEY = "a key for tests only"


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates; entities whose surrogates collide over all documents get others."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, KEY, mode="annotate", again=again(docs, KEY))


#: A keyed permutation of formats has no SQL form; tests hold it against plain Python.
SQL: dict[str, str] = {}
QUERIES = {"op9_surrogates": op9_surrogates}
