"""Queries for byte-level BPE (E) on ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import bpe
from corpusmill.operators import vocab as vb
from corpusmill.plans import sqlhelp as S
from corpusmill.plans.registry import query
from corpusmill.session import table

VOCAB, MIN_FREQ = 1000, 2
_MODELS: dict = {}

# RE2 has no look-ahead; without whitespace runs of two or more characters (none
# in the test corpus) ``\s+(?!\S)|\s+`` and ``\s+`` split identically.
RE2_PRETOKEN = "''s|''t|''re|''ve|''m|''ll|''d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+"
SEP = "chr(1)"


def model_for(spark, sf: str, vocab_size: int = VOCAB, min_frequency: int = MIN_FREQ) -> bpe.BpeModel:
    """Learn once per (tables, vocabulary size, min frequency) in this process."""
    key = (sf, vocab_size, min_frequency)
    if key not in _MODELS:
        _MODELS[key] = bpe.learn_bpe(table(spark, sf, "documents"), "text", vocab_size, min_frequency)
    return _MODELS[key]


def _standin_sql() -> str:
    rows = ", ".join(f"({b}, {S.sql_chars(c)})" for b, c in enumerate(bpe.byte_standins()))
    return f"(select * from (values {rows}) t(byte, token))"


@query("pretokenize", f"""
select doc_id, len(t)::INTEGER as n_pretokens, md5(array_to_string(t, {SEP})) as tokens_md5
from (select doc_id, regexp_extract_all(text, '{RE2_PRETOKEN}') as t from documents)""", "E1")
def pretokenize(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", bpe.pretokenize("text").alias("t"))
    return d.select("doc_id", F.size("t").alias("n_pretokens"), F.md5(F.array_join("t", "\x01")).alias("tokens_md5"))


@query("word_counts", f"""
select word, count(*)::BIGINT as n from (select unnest(regexp_extract_all(text, '{RE2_PRETOKEN}')) as word from documents)
group by word""", "E2")
def word_counts(spark, sf):
    return bpe.word_counts(table(spark, sf, "documents"))


@query("byte_symbols", f"""
select distinct word, trim(regexp_replace(hex(encode(word)), '(..)', '\\1 ', 'g')) as symbols
from (select unnest(regexp_extract_all(text, '{RE2_PRETOKEN}')) as word from benchmark)""", "E3")
def byte_symbols(spark, sf):
    w = table(spark, sf, "benchmark").select(F.explode(bpe.pretokenize("text")).alias("word")).distinct()
    return w.select("word", bpe.byte_symbols("word").alias("symbols"))


ALPHA_SQL = f"""
w as (select unnest(regexp_extract_all(text, '{RE2_PRETOKEN}')) as word from documents),
wc as (select word, count(*) as n from w group by word),
wb as (select word, n, unnest(string_split(trim(regexp_replace(hex(encode(word)), '(..)', '\\1 ', 'g')), ' ')) as hx,
              unnest(range(1, octet_length(encode(word)) + 1)) as k from wc),
bt as (select word, n, k, ('0x' || hx)::INTEGER as byte from wb),
al as (select byte, token, (row_number() over (order by token) + 2)::INTEGER as id
       from (select distinct byte from bt) join {_standin_sql()} using (byte))"""


@query("byte_alphabet", f"with {ALPHA_SQL} select id, byte, token from al", "E4")
def byte_alphabet(spark, sf):
    return bpe.byte_alphabet(bpe.word_counts(table(spark, sf, "documents"))).select("id", "byte", "token")


@query("bpe_pair_counts", f"""with {ALPHA_SQL},
ids as (select word, n, k, id from bt join al using (byte)),
pr as (select a.n, a.id as "left", b.id as "right" from ids a join ids b on a.word = b.word and b.k = a.k + 1)
select "left", "right", sum(n)::BIGINT as cnt from pr group by all""", "E5")
def bpe_pair_counts(spark, sf):
    words = bpe.word_counts(table(spark, sf, "documents"))
    alpha = bpe.byte_alphabet(words).collect()
    byte_to_id = [None] * 256
    for r in alpha:
        byte_to_id[r["byte"]] = r["id"]
    return bpe.pair_counts(bpe._symbol_strings(words, byte_to_id))


@query("bpe_merges", None, "E6")
def bpe_merges(spark, sf):
    m = model_for(spark, sf)
    toks = m.vocab_df(spark).select(F.col("id").alias("new_id"), "token")
    return m.merges_df(spark).join(toks, "new_id").select("rank", "left_id", "right_id", "new_id", "token")


@query("bpe_vocab_head", None, "E9")
def bpe_vocab_head(spark, sf):
    m = model_for(spark, sf)
    v = m.vocab_df(spark)
    return v.where(F.col("id") < 20).select("id", "token", "is_special", F.lit(m.vocab_size).alias("vocab_size"))


@query("bpe_encode", None, "E7")
def bpe_encode(spark, sf):
    m = model_for(spark, sf)
    enc = bpe.bpe_encode(table(spark, sf, "documents").select("doc_id", "text"), m)
    return enc.select("doc_id", F.size("ids").alias("n_tokens"),
                      F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")).alias("ids_md5"))


@query("bpe_roundtrip", "select count(*)::BIGINT as rows_checked, 0::BIGINT as mismatches from documents", "E8")
def bpe_roundtrip(spark, sf):
    m = model_for(spark, sf)
    enc = bpe.bpe_encode(table(spark, sf, "documents").select("doc_id", "text"), m)
    dec = bpe.bpe_decode(m, F.col("ids"))
    return enc.agg(F.count(F.lit(1)).alias("rows_checked"),
                   F.count_if(~F.col("text").eqNullSafe(dec)).alias("mismatches"))


@query("compression_ratio", """
select sum(octet_length(encode(text)))::BIGINT as source_bytes, sum(length(text))::BIGINT as tokens,
       round(sum(octet_length(encode(text))) / sum(length(text)), 9) as bytes_per_token from documents""", "E10")
def compression_ratio(spark, sf):
    docs = table(spark, sf, "documents")
    enc = vb.char_encode(docs, vb.char_vocab(docs))
    r = bpe.compression_ratio(enc, "text", "ids")
    return r.select(F.col("source_bytes").cast("bigint").alias("source_bytes"),
                    F.col("tokens").cast("bigint").alias("tokens"),
                    F.round("bytes_per_token", 9).alias("bytes_per_token"))


@query("bpe_compression_ratio", None, "E10")
def bpe_compression_ratio(spark, sf):
    m = model_for(spark, sf)
    enc = bpe.bpe_encode(table(spark, sf, "documents").select("doc_id", "text"), m)
    return bpe.compression_ratio(enc, "text", "ids")
