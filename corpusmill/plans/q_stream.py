"""Queries for the streaming forms (J): each drains the documents file as a
stream and must equal its batch twin."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from corpusmill.operators import vocab as vb
from corpusmill.plans import sqlhelp as S
from corpusmill.plans.q_tokens import STREAM_SQL
from corpusmill.plans.registry import query
from corpusmill.session import table
from corpusmill.streaming import corpus_stream as cs


def _glob(sf):
    return os.path.join(sf, "documents*.parquet")


@query("stream_clean", f"select doc_id, {S.strict('text')} as text from documents", "J1")
def stream_clean(spark, sf):
    return cs.stream_clean(spark, _glob(sf), "strict")


@query("stream_char_vocab", f"""
with v as ({S.vocab_sql('documents')}), f as (select ch, count(*)::BIGINT as n from ({S.char_rows('documents')}) group by ch)
select id, ch, n from v join f using (ch)""", "J2")
def stream_char_vocab(spark, sf):
    return cs.stream_char_vocab(spark, _glob(sf))


@query("stream_totals", f"""
select count(*)::BIGINT as docs, sum(length(text))::BIGINT as chars_in, sum(length({S.strict('text')}))::BIGINT as chars_out,
       sum(length({S.strict('text')}))::BIGINT as tokens, 100::DOUBLE as percent
from documents""", "J3")
def stream_totals(spark, sf):
    return cs.stream_totals(spark, _glob(sf), "strict")


@query("stream_char_encode", f"""with {STREAM_SQL}
select doc_id, count(*)::BIGINT as n_tokens, md5(string_agg(id::VARCHAR, ',' order by i)) as ids_md5 from t group by doc_id""",
       "J4")
def stream_char_encode(spark, sf):
    vocab = vb.char_vocab(table(spark, sf, "documents"))
    enc = cs.stream_char_encode(spark, _glob(sf), vocab)
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")).alias("ids_md5"))
