"""Queries for cleaning (B), cleaning profile (C) and the character codec (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import cleaning as cl
from corpusmill.operators import profile as pf
from corpusmill.operators import vocab as vb
from corpusmill.plans import sqlhelp as S
from corpusmill.plans.registry import query
from corpusmill.session import table

# The test corpus is Latin only.  To prove the emoji / CJK / control / rare-block
# rules do anything, these symbols are appended to every document on both sides.
INJECT = ("  　Ünïcödé ǖ ß Œ ™ “q” — 50 € \U0001F60A\U0001F916\U0001F680 ✂❤️ "
          "你好カタかな한국 x​y­z\x07\x7f﻿ \U000F0001 \U0001F1E6\U0001F1E8 a|b_c "
          "\n \n\n\n\n end \t  ")
INJECT_SQL = S.sql_chars(INJECT)


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _injected(spark, sf):
    return _docs(spark, sf).select("doc_id", F.concat("text", F.lit(INJECT)).alias("text"))


def _inj_sql():
    return f"(select doc_id, text || {INJECT_SQL} as text from documents)"


# ---- flagship ---------------------------------------------------------------------

def clean_strict_vocab(spark, sf):
    docs = _docs(spark, sf).select(cl.clean_strict(F.col("text")).alias("text"))
    return vb.char_vocab(docs)


query("clean_strict_vocab", S.vocab_sql(f"(select {S.strict('text')} as text from documents)"),
      "B9+D1")(clean_strict_vocab)


# ---- B: cleaning scalars on documents with injected symbols ------------------------

def _scalar_query(name, fn, sql_fn, section):
    def build(spark, sf):
        return _injected(spark, sf).select("doc_id", fn(F.col("text")).alias("out"))

    query(name, f"select doc_id, {sql_fn('text')} as out from {_inj_sql()}", section)(build)


def _decomposed_sql(x):
    """``strip_accents`` puts Hangul syllables together again: take them apart by the standard's arithmetic."""
    s = "(unicode(c) - 44032)"
    apart = (f"chr((4352 + {s} // 588)::INTEGER) || chr((4449 + {s} % 588 // 28)::INTEGER) || "
             f"case when {s} % 28 > 0 then chr((4519 + {s} % 28)::INTEGER) else '' end")
    return (f"array_to_string(list_transform(string_split(strip_accents({x}), ''), "
            f"lambda c: case when unicode(c) between 44032 and 55203 then {apart} else c end), '')")


_scalar_query("strip_accents", lambda c: cl.strip_accents(c), _decomposed_sql, "B1")
_scalar_query("keep_ascii_set", cl.keep_ascii_set, S.ascii_set, "B2")
_scalar_query("remove_emojis", cl.remove_emojis, S.emojis, "B3")
_scalar_query("remove_cjk", cl.remove_cjk, S.cjk, "B4")
_scalar_query("remove_control", cl.remove_control, S.control, "B5")
_scalar_query("keep_latin1", cl.keep_latin1, S.latin1, "B6")
_scalar_query("remove_rare_unicode", cl.remove_rare_unicode, S.rare, "B7")
_scalar_query("normalize_whitespace", cl.normalize_whitespace, S.ws_norm, "B8")
_scalar_query("clean_strict", cl.clean_strict, S.strict, "B9")
_scalar_query("clean_balanced", cl.clean_balanced, S.balanced, "B10")
_scalar_query("clean_lenient", cl.clean_lenient, S.lenient, "B11")


# ---- C: cleaning profile -------------------------------------------------------------

@query("clean_corpus_totals", f"""
select chars_in, chars_out, round(case when chars_in > 0 then (1 - chars_out / chars_in) * 100.0 else 0 end, 6)
       as pct_removed
from (select sum(length(text))::BIGINT as chars_in, sum(length({S.strict('text')}))::BIGINT as chars_out
      from documents)""", "C1")
def clean_corpus_totals(spark, sf):
    t = pf.clean_corpus_totals(_docs(spark, sf), "strict")
    return t.withColumn("pct_removed", F.round("pct_removed", 6))


def _stats_sql(mode: str, by: str | None, src: str):
    k = f"{by}, " if by else ""
    g = f"group by {by}" if by else ""
    j = f"using ({by})" if by else "on true"
    clean = S.MODE_SQL[mode]("text")
    return f"""
with c as (select {k}text as b, {clean} as a from {src}),
l as (select {k}sum(length(b))::BIGINT as chars_before, sum(length(a))::BIGINT as chars_after from c {g}),
vb as (select {k}count(distinct ch)::BIGINT as vocab_before from ({S.char_rows('c', 'b', by or '')}) {g}),
va as (select {k}count(distinct ch)::BIGINT as vocab_after from ({S.char_rows('c', 'a', by or '')}) {g})
select {k}chars_before, chars_after, coalesce(vocab_before, 0) as vocab_before, coalesce(vocab_after, 0) as vocab_after,
  chars_before - chars_after as chars_removed,
  round(case when chars_before > 0 then (chars_before - chars_after) / chars_before * 100.0 else 0 end, 6)
    as pct_chars_removed,
  coalesce(vocab_before, 0) - coalesce(vocab_after, 0) as vocab_reduced,
  round(case when coalesce(vocab_before, 0) > 0 then (vocab_before - vocab_after) / vocab_before * 100.0
        else 0 end, 6) as pct_vocab_reduced
from l left join vb {j} left join va {j}"""


def _round_stats(df):
    return (df.withColumn("pct_chars_removed", F.round("pct_chars_removed", 6))
            .withColumn("pct_vocab_reduced", F.round("pct_vocab_reduced", 6)))


@query("cleaning_stats", _stats_sql("strict", None, "documents"), "C2")
def cleaning_stats(spark, sf):
    return _round_stats(pf.cleaning_stats(_docs(spark, sf), "strict"))


@query("cleaning_stats_by_lang", _stats_sql("balanced", "lang", f"(select lang, text || {INJECT_SQL} as text from documents)"), "C2")
def cleaning_stats_by_lang(spark, sf):
    d = _docs(spark, sf).select("lang", F.concat("text", F.lit(INJECT)).alias("text"))
    return _round_stats(pf.cleaning_stats(d, "balanced", by=["lang"]))


@query("should_clean", f"""
select source, count(distinct ch)::BIGINT as vocab_size, count(distinct ch) > 500 as should_clean,
       count(distinct ch) > 100 as should_clean_100
from ({S.char_rows('documents', 'text', 'source')}) group by source""", "C3")
def should_clean(spark, sf):
    chars = pf.distinct_chars(_docs(spark, sf), "text", by=["source"])
    v = chars.groupBy("source").agg(F.count(F.lit(1)).alias("vocab_size"))
    return v.select("source", "vocab_size", pf.should_clean("vocab_size").alias("should_clean"),
                    pf.should_clean("vocab_size", 100).alias("should_clean_100"))


def _rec_sql(v):
    parts = []
    for bound, s, m, r in pf.RECOMMENDATION_RULES:
        mm = "NULL" if m is None else f"'{m}'"
        val = f"{{'should_clean': {str(s).lower()}, 'mode': {mm}, 'reason': '{r}'}}"
        parts.append(f"when {v} < {bound} then {val}" if bound is not None else f"else {val}")
    return "case " + " ".join(parts) + " end"


@query("cleaning_recommendation", f"""
with w as (select lang, source, count(distinct word)::BIGINT as vocab_size
           from (select lang, source, unnest(regexp_extract_all(text, '[^ \\n]+')) as word from documents)
           group by all),
r as (select lang, source, vocab_size, {_rec_sql('vocab_size')} as rec from w)
select lang, source, vocab_size, rec.should_clean as should_clean, rec.mode as mode, rec.reason as reason from r""",
       "C4")
def cleaning_recommendation(spark, sf):
    # the recommendation is a pure function of a vocabulary size; the word
    # vocabulary per (lang, source) spans all five bands on the test corpus
    words = (_docs(spark, sf)
             .select("lang", "source", F.explode(F.regexp_extract_all("text", F.lit("[^ \\n]+"), 0)).alias("w"))
             .groupBy("lang", "source").agg(F.count_distinct("w").alias("vocab_size")))
    rec = pf.cleaning_recommendation("vocab_size")
    return words.select("lang", "source", "vocab_size", rec["should_clean"].alias("should_clean"),
                        rec["mode"].alias("mode"), rec["reason"].alias("reason"))


# ---- D: character vocabulary and codec ------------------------------------------------

@query("char_vocab", S.vocab_sql("documents"), "D1")
def char_vocab(spark, sf):
    return vb.char_vocab(_docs(spark, sf))


@query("char_frequency", f"select ch, count(*)::BIGINT as n from ({S.char_rows('documents')}) group by ch", "D7")
def char_frequency(spark, sf):
    return vb.char_frequency(_docs(spark, sf))


@query("vocab_head", f"""
select count(*)::BIGINT as vocab_size, string_agg(case when id < 20 then ch end, '' order by id) as head
from ({S.vocab_sql('documents')})""", "D6")
def vocab_head(spark, sf):
    return vb.vocab_stats(vb.char_vocab(_docs(spark, sf)), 20)


def _encode_sql(vocab_table: str) -> str:
    return f"""
with v as ({S.vocab_sql(vocab_table)}),
c as (select conv_id, turn, unnest(string_split(text, '')) as ch,
             unnest(range(1, length(string_split(text, '')) + 1)) as pos from conversations),
e as (select conv_id, turn, string_agg(id::VARCHAR, ',' order by pos) as ids,
             string_agg(v.ch, '' order by pos) as decoded
      from c join v using (ch) group by conv_id, turn)
select cv.conv_id, cv.turn, coalesce(e.ids, '') as ids, coalesce(e.decoded, '') as decoded
from conversations cv left join e using (conv_id, turn)"""


@query("char_encode", f"select conv_id, turn, ids from ({_encode_sql('benchmark')})", "D3")
def char_encode(spark, sf):
    # vocabulary of the English benchmark texts: accented characters of the
    # conversations are unknown and must be dropped
    vocab = vb.char_vocab(table(spark, sf, "benchmark"))
    enc = vb.char_encode(table(spark, sf, "conversations"), vocab)
    return enc.select("conv_id", "turn", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("char_decode", f"select conv_id, turn, decoded from ({_encode_sql('benchmark')})", "D4")
def char_decode(spark, sf):
    vocab = vb.char_vocab(table(spark, sf, "benchmark"))
    codec = vb.CharCodec(vocab)
    conv = table(spark, sf, "conversations")
    return conv.select("conv_id", "turn", codec.decode(codec.encode(F.col("text"))).alias("decoded"))


@query("char_roundtrip", f"""
with d as (select conv_id, turn, text, decoded from conversations join ({_encode_sql('documents')}) using (conv_id, turn))
select count(*)::BIGINT as rows_checked, count(*) filter (where text is distinct from decoded)::BIGINT as mismatches
from d""", "D5")
def char_roundtrip(spark, sf):
    vocab = vb.char_vocab(_docs(spark, sf))
    return vb.roundtrip_mismatches(table(spark, sf, "conversations"), vocab)
