"""Query of cross-tokenizer alignment."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.align import align
from corpusmill.llm.common import read

#: Folder of the tokenizer files; read by the driver, which hands their content to the tasks.
TOKENIZERS = "/opt/tokenizers"


def op11_align(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Every document's token links between the byte-level and the sentence-piece vocabulary."""
    a, b = Path(tokenizers, "byte_bpe_50k.json").read_text("utf-8"), Path(tokenizers, "piece_bpe_32k.model").read_bytes()
    return align(read(spark, sf_dir, "documents"), a, b).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
QUERIES = {"op11_align": op11_align}
