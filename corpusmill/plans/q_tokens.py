"""Queries for the token dataset (F) on character tokens of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import dataset as ds
from corpusmill.operators import vocab as vb
from corpusmill.plans import sqlhelp as S
from corpusmill.plans.registry import query
from corpusmill.session import scratch_path, table

RATIO = 0.9
WIN_LEN, WIN_BATCH, WIN_BATCHES, WIN_SEED = 64, 8, 4, 1337
ALL_LEN, ALL_BATCH, ALL_BATCHES, ALL_SEED = 128, 4, 4, 2024
SEQ_LEN = 256


def char_tokens(spark, sf):
    """``(doc_id, ids)`` character tokens of the raw documents."""
    docs = table(spark, sf, "documents")
    return vb.char_encode(docs, vb.char_vocab(docs)).select("doc_id", "ids")


def tokens_with_offsets(spark, sf):
    return ds.token_offsets(char_tokens(spark, sf))


def _ids_str(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# SQL: the same stream built with unnest / window functions in DuckDB
STREAM_SQL = f"""
v as ({S.vocab_sql('documents')}),
c as (select doc_id, unnest(string_split(text, '')) as ch,
             unnest(range(0, length(string_split(text, '')))) as i from documents),
t as (select doc_id, i, id from c join v using (ch)),
d as (select doc_id, count(*)::BIGINT as n_tokens from t group by doc_id),
o as (select doc_id, n_tokens,
             (sum(n_tokens) over (order by doc_id rows between unbounded preceding and current row)
              - n_tokens)::BIGINT as start_pos from d),
s as (select t.doc_id, (o.start_pos + row_number() over (partition by t.doc_id order by t.i) - 1)::BIGINT as pos,
             t.id from t join o using (doc_id)),
tot as (select sum(n_tokens)::BIGINT as total, floor(sum(n_tokens) * {RATIO}::DOUBLE)::BIGINT as idx from d)"""


@query("token_stream_offsets", f"with {STREAM_SQL} select doc_id, n_tokens, start_pos from o", "F1")
def token_stream_offsets(spark, sf):
    return tokens_with_offsets(spark, sf).select("doc_id", "n_tokens", "start_pos")


@query("token_stream_blocks", f"""with {STREAM_SQL}
select (pos // 65536)::BIGINT as blk, count(*)::BIGINT as n, sum(id)::BIGINT as sum_id,
       sum(id * (pos % 997))::BIGINT as checksum, min(pos)::BIGINT as first_pos from s group by 1""", "F1")
def token_stream_blocks(spark, sf):
    s = ds.token_stream(tokens_with_offsets(spark, sf))
    return (s.groupBy(F.floor(F.col("pos") / 65536).cast("bigint").alias("blk"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("id").cast("bigint").alias("sum_id"),
                 F.sum(F.col("id") * (F.col("pos") % 997)).cast("bigint").alias("checksum"),
                 F.min("pos").alias("first_pos")))


@query("prefix_split", f"""with {STREAM_SQL}
select case when pos < idx then 'train' else 'val' end as split, count(distinct doc_id)::BIGINT as n_docs,
       count(*)::BIGINT as n_tokens, min(pos)::BIGINT as first_pos, max(pos)::BIGINT as last_pos,
       max(idx) as split_index
from s, tot group by 1""", "F2")
def prefix_split(spark, sf):
    t = tokens_with_offsets(spark, sf)
    idx = t.agg(ds.split_index(F.sum("n_tokens"), RATIO)).first()[0]
    parts = ds.split_documents(t, idx)
    return (parts.groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("ids")).cast("bigint").alias("n_tokens"),
                 F.min("start_pos").alias("first_pos"),
                 F.max(F.col("start_pos") + F.size("ids") - 1).alias("last_pos"))
            .withColumn("split_index", F.lit(idx).cast("bigint")))


def _windows_sql(split_expr, lo, hi, L, B, nb, seed, sort):
    slot = ("(row_number() over (partition by split, batch order by start, draw) - 1)::BIGINT" if sort
            else "draw")
    return f"""
w as (select '{split_expr}' as split, (g // {B})::BIGINT as batch, (g % {B})::BIGINT as draw
      from generate_series(0, {B * nb - 1}) t(g), tot),
ws as (select split, batch, draw,
              ({lo} + floor({S.md5_unit(f"concat_ws(':', {seed}, split, batch, draw)")}
                            * ({hi} - {L} - 1 - ({lo}))))::BIGINT as start from w, tot),
sl as (select split, batch, {slot} as slot, start from ws),
wt as (select split, batch, slot, start, list(id order by pos) as l from sl join s on s.pos between start and start + {L}
       group by all)"""


def _win_select(L):
    return (f"select split, batch, slot, start, array_to_string(list_slice(l, 1, {L}), ',') as x, "
            f"array_to_string(list_slice(l, 2, {L + 1}), ',') as y from wt")


WINDOWS_SQL = f"""with {STREAM_SQL}, {_windows_sql('train', 0, 'idx', WIN_LEN, WIN_BATCH, WIN_BATCHES, WIN_SEED, True)}
{_win_select(WIN_LEN)}
union all
(with {STREAM_SQL}, {_windows_sql('val', 'idx', 'total', WIN_LEN, WIN_BATCH, WIN_BATCHES, WIN_SEED, True)}
{_win_select(WIN_LEN)})"""


def _starts(spark, t):
    total = t.agg(F.sum("n_tokens")).first()[0]
    idx = int(total * RATIO)
    return (ds.window_starts(spark, 0, idx, WIN_LEN, WIN_BATCH, WIN_BATCHES, WIN_SEED, "train")
            .unionByName(ds.window_starts(spark, idx, total, WIN_LEN, WIN_BATCH, WIN_BATCHES, WIN_SEED, "val")))


def _windows(blocks, starts):
    w = ds.sample_windows(blocks, starts, WIN_LEN, WIN_LEN + 1)
    return w.select("split", "batch", "slot", "start", _ids_str("x").alias("x"), _ids_str("y").alias("y"))


@query("sample_windows", WINDOWS_SQL, "F3")
def sample_windows(spark, sf):
    t = tokens_with_offsets(spark, sf)
    starts = _starts(spark, t)
    return _windows(ds.token_blocks(t, WIN_LEN + 1, only=ds.needed_blocks(starts, WIN_LEN + 1)), starts)


@query("sample_windows_layout", WINDOWS_SQL, "F3")
def sample_windows_layout(spark, sf):
    """The same windows from a kept block layout of the whole stream."""
    t = tokens_with_offsets(spark, sf)
    path = scratch_path(spark, "blocks")
    ds.write_blocks(ds.token_blocks(t, WIN_LEN + 1, ranged=True), path, ranged=True)
    starts = _starts(spark, t)
    return _windows(ds.read_blocks(spark, path, starts, WIN_LEN + 1), starts)


@query("sample_windows_all", f"""with {STREAM_SQL}, {_windows_sql('all', 0, 'total', ALL_LEN, ALL_BATCH, ALL_BATCHES, ALL_SEED, False)}
{_win_select(ALL_LEN)}""", "F4")
def sample_windows_all(spark, sf):
    t = tokens_with_offsets(spark, sf)
    total = t.agg(F.sum("n_tokens")).first()[0]
    starts = ds.window_starts(spark, 0, total, ALL_LEN, ALL_BATCH, ALL_BATCHES, ALL_SEED, "all", sort=False)
    blocks = ds.token_blocks(t, ALL_LEN + 1, only=ds.needed_blocks(starts, ALL_LEN + 1))
    w = ds.sample_windows(blocks, starts, ALL_LEN, ALL_LEN + 1)
    return w.select("split", "batch", "slot", "start", _ids_str("x").alias("x"), _ids_str("y").alias("y"))


PLAN = dict(seq_len=64, batch_size=16, epochs=3, start_epoch=1, max_steps_per_epoch=100)


@query("dataset_plan", f"""with {STREAM_SQL}
select total as total_tokens, idx as train_split_index,
  (idx // 1024)::BIGINT as full_steps_per_epoch, least(100, idx // 1024)::BIGINT as steps_per_epoch,
  1024::BIGINT as tokens_per_step, 2 as remaining_epochs,
  (least(100, idx // 1024) * 2048)::BIGINT as tokens_seen,
  round(case when idx > 0 then least(100, idx // 1024) * 2048 / idx end, 9) as times_dataset,
  ((total - 1) // 64)::BIGINT as num_sequences, least((total - 1) // 64 // 16, 5000)::BIGINT as finetune_steps_per_epoch
from tot""", "F5")
def dataset_plan(spark, sf):
    t = tokens_with_offsets(spark, sf)
    m = t.agg(F.sum("n_tokens").alias("total_tokens")).withColumn(
        "train_split_index", ds.split_index(F.col("total_tokens"), RATIO))
    return ds.dataset_plan(m, **PLAN).withColumn("times_dataset", F.round("times_dataset", 9))


@query("sequential_blocks", f"""with {STREAM_SQL},
b as (select pos // {SEQ_LEN} as seq, list(id order by pos) as l from s group by 1),
x as (select b.seq, b.l as x, list_concat(list_slice(b.l, 2, {SEQ_LEN}), [n.l[1]]) as y
      from b left join b n on n.seq = b.seq + 1, tot where b.seq < (total - 1) // {SEQ_LEN})
select seq::BIGINT as seq, md5(array_to_string(x, ',')) as x_md5, md5(array_to_string(y, ',')) as y_md5 from x""",
       "F6")
def sequential_blocks(spark, sf):
    t = tokens_with_offsets(spark, sf)
    total = t.agg(F.sum("n_tokens")).first()[0]
    seqs = ds.sequential_blocks(ds.token_blocks(t, SEQ_LEN, overlap=1), total, SEQ_LEN)
    return seqs.select("seq", F.md5(_ids_str("x")).alias("x_md5"), F.md5(_ids_str("y")).alias("y_md5"))


@query("token_preview", f"""with {STREAM_SQL}
select array_to_string(list(id order by pos) filter (where pos < 10), ',') as first_ids,
       substr(string_agg(v.ch, '' order by pos) filter (where pos < 100), 1, 80) as sample
from s join v using (id)""", "F7")
def token_preview(spark, sf):
    docs = table(spark, sf, "documents")
    vocab = vb.char_vocab(docs)
    codec = vb.CharCodec(vocab)
    t = ds.token_offsets(docs.select("doc_id", codec.encode(F.col("text")).alias("ids")))
    head = ds.stream_head(t, 100)
    return head.select(_ids_str(F.slice("head", 1, 10)).alias("first_ids"),
                       F.substring(codec.decode(F.col("head")), 1, 80).alias("sample"))


@query("context_tail", f"""
with v as ({S.vocab_sql('documents')}),
c as (select conv_id, turn, unnest(string_split(text, '')) as ch,
             unnest(range(0, length(string_split(text, '')))) as i from conversations),
e as (select conv_id, turn, list(id order by i) as ids from c join v using (ch) group by all)
select cv.conv_id, cv.turn, coalesce(array_to_string(list_slice(e.ids, greatest(1, len(e.ids) - 32 + 1), len(e.ids)), ','), '')
       as tail
from conversations cv left join e using (conv_id, turn)""", "F8")
def context_tail(spark, sf):
    vocab = vb.char_vocab(table(spark, sf, "documents"))
    enc = vb.char_encode(table(spark, sf, "conversations"), vocab)
    return enc.select("conv_id", "turn", _ids_str(ds.context_tail("ids", 32)).alias("tail"))


@query("sample_without_replacement", f"""
select doc_id, lang from documents
order by ('0x' || substr(md5(concat_ws(':', 7, doc_id)), 1, 8))::BIGINT, doc_id limit 50""", "F9")
def sample_without_replacement(spark, sf):
    return ds.sample_without_replacement(table(spark, sf, "documents").select("doc_id", "lang"), 50, 7, "doc_id")


@query("sample_with_replacement", f"""
with n as (select count(*) as n from documents),
r as (select doc_id, lang, (row_number() over (order by doc_id) - 1) as rn from documents),
d as (select g as draw, floor({S.md5_unit("concat_ws(':', 11, g)")} * n)::BIGINT as rn
      from generate_series(0, 49) t(g), n)
select d.draw::BIGINT as draw, r.doc_id, r.lang from d join r using (rn)""", "F9")
def sample_with_replacement(spark, sf):
    return ds.sample_with_replacement(table(spark, sf, "documents").select("doc_id", "lang"), 50, 11, "doc_id")
