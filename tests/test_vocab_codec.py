from pyspark.sql import functions as F

from corpusmill.functions import cleaning as cl
from corpusmill.operators import vocab as vb
from corpusmill.sources import corpus as io
from tests.conftest import SF001


def test_anchor_counts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert vb.char_vocab(docs).count() == 99
    strict = docs.select(cl.clean_strict(F.col("text")).alias("text"))
    assert vb.char_vocab(strict).count() == 77


def test_vocab_dense_code_point_order(spark):
    df = spark.createDataFrame([("ba\U0001F600é",), ("cab",)], "text string")
    rows = vb.char_vocab(df).orderBy("id").collect()
    assert [r.ch for r in rows] == sorted("abcé\U0001F600")
    assert [r.id for r in rows] == list(range(5))


def test_hello_world_roundtrip_and_unknowns(spark):
    vocab = vb.char_vocab(spark.createDataFrame([("Hello, World!",)], "text string"))
    codec = vb.CharCodec(vocab)
    df = spark.createDataFrame([("Hello, World!",), ("Hey Zed!",), ("",)], "text string")
    out = df.select("text", codec.encode(F.col("text")).alias("ids")).collect()
    chars = sorted(set("Hello, World!"))
    assert out[0].ids == [chars.index(c) for c in "Hello, World!"]
    assert out[1].ids == [chars.index(c) for c in "He ed!"]  # y and Z are unknown and dropped
    assert out[2].ids == []
    dec = spark.createDataFrame([([0, 99, -1, 1],)], "ids array<int>").select(codec.decode(F.col("ids")).alias("t"))
    assert dec.first().t == chars[0] + chars[1]


def test_every_character_has_one_path(spark):
    texts = ["a\U0001F600b", "\U0010FFFF\u4e2d é", "", "\U00020001\U0001F600"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    codec = vb.CharCodec(vb.char_vocab(df))
    chars = sorted(set("".join(texts)))
    got = {r.doc_id: (r.ids, r.back) for r in df.select("doc_id", codec.encode(F.col("text")).alias("ids"), codec.decode(codec.encode(F.col("text"))).alias("back")).collect()}
    assert got == {i: ([chars.index(c) for c in t], t) for i, t in enumerate(texts)}


def test_vocab_json_roundtrip(spark, tmpdir_fresh):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    vocab = vb.char_vocab(docs)
    io.save_vocab(vocab, tmpdir_fresh + "/v")
    doc = spark.read.schema(io.VOCAB_SCHEMA).json(tmpdir_fresh + "/v").first()
    assert doc.type == "character" and doc.vocab_size == 99
    back = io.load_vocab(spark, tmpdir_fresh + "/v")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, vocab.collect()))
    inv = doc.idx_to_char
    assert all(inv[str(r.id)] == r.ch for r in vocab.collect())
