"""End-to-end plans: corpus -> token dataset (clean, learn, encode, lay out,
describe) and the tokenizer dispatch of its readers (E11)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import cleaning as cl
from corpusmill.operators import bpe
from corpusmill.operators import vocab as vb
from corpusmill.session import checkpoint_dir
from corpusmill.sources import corpus as io


def prepare_token_dataset(spark: SparkSession, docs: DataFrame, out_dir: str, output_name: str = "tokens",
                          tokenizer: str = "bpe", clean_mode: str | None = None, vocab_size: int = 32000,
                          min_frequency: int = 2, train_split: float = 0.9, source_file: str = "",
                          source_size_bytes: int = 0, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Clean (optional) -> vocabulary -> encode -> write tokens + manifest.

    The cleaned corpus is materialised once by ``checkpoint()`` (it is read by
    both the vocabulary and the encoder); no temporary file is left behind.
    Returns the manifest row.
    """
    checkpoint_dir(spark)
    d = docs.select(key, text_col)
    if clean_mode:
        d = d.withColumn(text_col, cl.clean(F.col(text_col), clean_mode)).checkpoint()
    if tokenizer == "bpe":
        model = bpe.learn_bpe(d, text_col, vocab_size, min_frequency)
        io.save_bpe(spark, model, os.path.join(out_dir, "bpe_tokenizer"))
        tokens = bpe.bpe_encode(d, model, text_col).select(key, "ids")
        size, tok_file, dtype = model.vocab_size, "bpe_tokenizer", "int32"
    elif tokenizer == "character":
        vocab = vb.char_vocab(d, text_col)
        io.save_vocab(vocab, os.path.join(out_dir, "tokenizer.json"))
        codec = vb.CharCodec(vocab)
        tokens = d.select(key, codec.encode(F.col(text_col)).alias("ids"))
        size, tok_file, dtype = codec.size, "tokenizer.json", "int16" if codec.size <= 1 << 15 else "int32"
    else:
        raise ValueError(f"unknown tokenizer type: {tokenizer}")
    tok_path = os.path.join(out_dir, output_name)
    io.write_tokens(tokens, tok_path)
    written = spark.read.parquet(tok_path)
    manifest = io.dataset_manifest(written, size, tokenizer, dtype, train_split, source_file, source_size_bytes,
                                   output_name, tok_file, bool(clean_mode), clean_mode, vocab_size, min_frequency)
    io.write_manifest(manifest, os.path.join(out_dir, f"{output_name}_metadata.json"))
    return io.read_manifest(spark, os.path.join(out_dir, f"{output_name}_metadata.json"))


def load_codec(spark: SparkSession, manifest_row, out_dir: str):
    """Tokenizer dispatch on the manifest's type, default character.
    Returns ``(encode, decode)`` column functions."""
    kind = (manifest_row["tokenizer_type"] if manifest_row is not None else None) or "character"
    if kind == "bpe":
        model = io.load_bpe(spark, os.path.join(out_dir, "bpe_tokenizer"))
        return bpe.bpe_encoder(model), (lambda ids: bpe.bpe_decode(model, ids))
    codec = vb.CharCodec(io.load_vocab(spark, os.path.join(out_dir, "tokenizer.json")))
    return codec.encode, codec.decode
