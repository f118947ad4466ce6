from pyspark.sql import functions as F

from corpusmill.plans import prepare
from corpusmill.sources import corpus as io
from tests.conftest import SF001


def test_prepare_character_dataset(spark, tmpdir_fresh):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    m = prepare.prepare_token_dataset(spark, docs, tmpdir_fresh, "docs", tokenizer="character",
                                      clean_mode="strict").first()
    assert m.total_tokens == 483383 and m.vocab_size == 77 and m.cleaning_mode == "strict" and m.dtype == "int16"
    toks = io.read_tokens(spark, tmpdir_fresh + "/docs", m.dtype)
    assert io.validate_manifest(toks, io.read_manifest(spark, tmpdir_fresh + "/docs_metadata.json")).first().ok
    enc, dec = prepare.load_codec(spark, m, tmpdir_fresh)
    back = toks.select(dec(F.col("ids").cast("array<int>")).alias("t")).agg(F.sum(F.length("t"))).first()[0]
    assert back == 483383


def test_prepare_bpe_dataset(spark, tmpdir_fresh):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(30)
    m = prepare.prepare_token_dataset(spark, docs, tmpdir_fresh, "b", tokenizer="bpe", vocab_size=120).first()
    assert m.tokenizer_type == "bpe" and m.vocab_size == 120 and m.cleaning_mode is None
    _, dec = prepare.load_codec(spark, m, tmpdir_fresh)
    toks = spark.read.parquet(tmpdir_fresh + "/b").join(docs, "doc_id")
    assert toks.where(dec(F.col("ids")) != F.col("text")).count() == 0
