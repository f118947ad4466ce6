"""From raw documents to a training mixture: five stages, each a table that the next one reads.

Quality rules drop rejected documents, the n-gram Jaccard join keeps one of each
group of near copies, benchmark decontamination drops contaminated documents,
personal data gets surrogates, and mixing deals the rest out to target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import quality
from corpusmill.llm.common import read, stored
from corpusmill.llm.decontaminate import decontaminate
from corpusmill.llm.mixing import mix
from corpusmill.llm.q_surrogates import KEY
from corpusmill.llm.setjoin import jaccard_components
from corpusmill.llm.surrogates import again, pseudonymise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fitted ratio."""
    return quality.judge(docs, quality.fit(docs, read(spark, sf_dir, "labels")), mode="filter")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id; of equal rows, one.

    Documents without an id or without words are nobody's copies and stay.  Different
    texts under one id stay if any of them would.
    """
    found = stored(jaccard_components(docs.select("doc_id", "text")).select("id", "component"), "components")
    first = found.where("id = component").groupBy("id").count()
    lost = found.where("id <> component").select(F.col("id").alias("doc_id")).distinct()
    lost = stored(lost.join(first.select(F.col("id").alias("doc_id")), "doc_id", "left_anti"), "copies")
    rest = docs.join(lost, "doc_id", "left_anti")
    repeated = stored(first.where("count > 1").select(F.col("id").alias("doc_id")), "repeated")
    if repeated.isEmpty():
        return rest.select(docs.columns)
    once = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"), mode="documents")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by surrogates that don't collide."""
    return pseudonymise(docs, KEY, again=again(docs, KEY))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each use of a document in the mixture of sources."""
    return mix(docs)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark_passages),
          ("PII", personal_data), ("mixing sources", mixture)]

#: The first stage's verdict is a sum of fitted weights: no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
