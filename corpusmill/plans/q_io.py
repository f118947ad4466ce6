"""Queries for sources and sinks (A)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from corpusmill.operators import runlog as rl
from corpusmill.operators import vocab as vb
from corpusmill.plans import sqlhelp as S
from corpusmill.plans.q_tokens import STREAM_SQL, char_tokens
from corpusmill.plans.registry import query
from corpusmill.session import scratch_path, table
from corpusmill.sources import corpus as io

E, TRAIN_STEPS = 20, 18  # epoch length of the run log and its positional 0.9 train prefix


def _docs_path(sf):
    return os.path.join(sf, "documents.parquet")


@query("scan_corpus", """
select doc_id, length(regexp_replace(text, '\\r\\n?', chr(10), 'g'))::BIGINT as n_chars_read,
       octet_length(encode(text))::BIGINT as n_bytes, n_chars = length(text) as n_chars_agree,
       'documents.parquet' as source_file from documents""", "A1+A2+A14")
def scan_corpus(spark, sf):
    d = io.read_corpus(spark, _docs_path(sf))
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_chars_read"),
                    F.octet_length("text").cast("bigint").alias("n_bytes"),
                    (F.col("n_chars") == F.length("text")).alias("n_chars_agree"), "source_file")


@query("scan_text_corpus", """
select line, count(*)::BIGINT as n from (select unnest(string_split(text, chr(10))) as line from documents) group by line""", "A1")
def scan_text_corpus(spark, sf):
    """The documents as text files, read back in byte ranges: every line."""
    path = scratch_path(spark, "lines")
    table(spark, sf, "documents").where("text is not null").select("text").write.text(path)
    pieces = io.scan_text(spark, path, piece_bytes=1 << 16)
    # each piece ends with its last line's end
    line = F.explode(F.expr("slice(split(text, '\\n'), 1, size(split(text, '\\n')) - 1)"))
    return pieces.select(line.alias("line")).groupBy("line").agg(F.count("*").alias("n"))


@query("token_sink_roundtrip", f"""with {STREAM_SQL}
select doc_id, count(*)::BIGINT as n_tokens, sum(id)::BIGINT as id_sum, min(id) filter (where i = 0)::SMALLINT as first_id
from t group by doc_id""", "A4+A5")
def token_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "tokens")
    io.write_tokens(char_tokens(spark, sf), path)
    # a document with an empty text has no tokens: no row
    t = io.read_tokens(spark, path, "int16").where(F.coalesce(F.size("ids"), F.lit(1)) > 0)
    return t.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                    F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"),
                    F.element_at("ids", 1).alias("first_id"))


@query("compression_report", None, "A6")
def compression_report(spark, sf):
    return io.compression_report(spark, char_tokens(spark, sf), scratch_path(spark, "compress"), "gzip")


def _manifest(spark, sf):
    docs = table(spark, sf, "documents")
    files = docs.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    size = files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    vocab_size = vb.char_vocab(docs).count()
    return io.dataset_manifest(char_tokens(spark, sf), vocab_size, tokenizer_type="character", dtype="int16",
                               source_file=_docs_path(sf), source_size_bytes=size, output_name="documents",
                               tokenizer_file="tokenizer.json", cleaned=False, cleaning_mode="balanced")


MANIFEST_SQL = f"""with {STREAM_SQL}
select total as total_tokens, (select count(*) from v)::INTEGER as vocab_size, 'character' as tokenizer_type,
  'int16' as dtype, 2 as bytes_per_token, 0.9::DOUBLE as train_split, idx as train_split_index, idx as train_tokens,
  total - idx as val_tokens, 'documents.parquet' as source_file, 'documents.bin' as bin_file,
  'tokenizer.json' as tokenizer_file, false as cleaned, NULL::VARCHAR as cleaning_mode,
  32000 as bpe_vocab_size_requested, 2 as bpe_min_frequency from tot"""


@query("dataset_manifest", MANIFEST_SQL, "A7")
def dataset_manifest(spark, sf):
    return _manifest(spark, sf).drop("created", "source_size_bytes")


@query("manifest_roundtrip", MANIFEST_SQL, "A7+A8")
def manifest_roundtrip(spark, sf):
    path = scratch_path(spark, "manifest")
    io.write_manifest(_manifest(spark, sf), path)
    return io.read_manifest(spark, path).drop("created", "source_size_bytes")


@query("manifest_check", f"""with {STREAM_SQL}
select total as actual, total as expected, true as ok from tot""", "A9")
def manifest_check(spark, sf):
    return io.validate_manifest(char_tokens(spark, sf), _manifest(spark, sf))


@query("vocab_json_roundtrip", S.vocab_sql("documents"), "A10")
def vocab_json_roundtrip(spark, sf):
    path = scratch_path(spark, "vocab")
    io.save_vocab(vb.char_vocab(table(spark, sf, "documents")), path)
    return io.load_vocab(spark, path)


def _epochs(spark, sf):
    """Completed epochs: a history has no others."""
    return rl.epoch_losses(rl.events_as_run_log(table(spark, sf, "events"), E, 4096), E, TRAIN_STEPS)


def _j(c):
    return F.array_join(F.transform(c, lambda x: F.round(x, 6).cast("string")), ",")


@query("training_history", f"""
with g as (select user_id as run_id, value as loss, row_number() over (partition by user_id order by event_id) as gstep
           from events),
lg as (select run_id, (gstep - 1) // {E} + 1 as epoch, (gstep - 1) % {E} + 1 as step, loss from g),
ep as (select run_id, epoch, avg(loss) filter (where step <= {TRAIN_STEPS}) as train_loss,
              avg(loss) filter (where step > {TRAIN_STEPS}) as val_loss from lg group by all having count(*) = {E})
select run_id, max(epoch)::INTEGER as epochs_completed,
  array_to_string(list(round(train_loss, 6)::VARCHAR order by epoch), ',') as train_losses,
  array_to_string(list(round(val_loss, 6)::VARCHAR order by epoch), ',') as val_losses,
  round(min(train_loss), 6) as best_train_loss, round(min(val_loss), 6) as best_val_loss,
  arg_min(epoch, (val_loss, epoch))::INTEGER as best_epoch
from ep group by run_id""", "A12")
def training_history(spark, sf):
    path = scratch_path(spark, "history")
    io.write_history(io.training_history(_epochs(spark, sf)), path)
    h = io.read_history(spark, path)
    best = io.training_history(_epochs(spark, sf)).select("run_id", "best_train_loss", "best_val_loss", "best_epoch")
    return h.join(best, "run_id").select(
        "run_id", "epochs_completed", _j("train_losses").alias("train_losses"), _j("val_losses").alias("val_losses"),
        F.round("best_train_loss", 6).alias("best_train_loss"), F.round("best_val_loss", 6).alias("best_val_loss"),
        "best_epoch")


@query("run_report", f"""
with g as (select user_id as run_id, value as loss, row_number() over (partition by user_id order by event_id) as gstep
           from events),
lg as (select run_id, (gstep - 1) // {E} + 1 as epoch, (gstep - 1) % {E} + 1 as step, loss from g),
ep as (select run_id, epoch, avg(loss) filter (where step <= {TRAIN_STEPS}) as train_loss,
              avg(loss) filter (where step > {TRAIN_STEPS}) as val_loss from lg group by all having count(*) = {E}),
last as (select run_id, max(epoch)::INTEGER as epochs, arg_max(train_loss, epoch) as train_loss,
                arg_max(val_loss, epoch) as val_loss, min(val_loss) as best_val_loss,
                arg_min(epoch, (val_loss, epoch))::INTEGER as best_epoch from ep group by run_id)
select run_id, 'documents.bin' as dataset_bin, epochs, 64::INTEGER as batch_size, 0.0003::DOUBLE as learning_rate,
  0::DOUBLE as duration_minutes, 'cpu' as device, round(train_loss, 6) as final_train_loss, round(val_loss, 6) as final_val_loss,
  round(ln(exp(train_loss)), 6) as final_train_perplexity_log, round(ln(exp(val_loss)), 6) as final_val_perplexity_log,
  round(best_val_loss, 6) as best_val_loss, best_epoch from last""", "A13")
def run_report(spark, sf):
    """Each run's report as JSON, read back; perplexities as logarithms, since they may have any size."""
    h = io.training_history(_epochs(spark, sf))
    r = io.run_report(h, "documents.bin", batch_size=64, learning_rate=3e-4, duration_minutes=0.0)
    report = F.struct("dataset_bin", "training", "performance")
    back = r.select("run_id", F.from_json(F.to_json(report), r.select(report.alias("r")).schema["r"].dataType).alias("r"))
    p = back.select("run_id", "r.dataset_bin", "r.training.*", "r.performance.*")
    six = [F.round(c, 6).alias(c) for c in ("final_train_loss", "final_val_loss", "best_val_loss")]
    logs = [F.round(F.log(c), 6).alias(f"{c}_log") for c in ("final_train_perplexity", "final_val_perplexity")]
    return p.select("run_id", "dataset_bin", "epochs", "batch_size", "learning_rate", "duration_minutes", "device", *six, *logs, "best_epoch")
