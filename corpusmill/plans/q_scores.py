"""Queries for scored rows (G): ``embeddings.embedding`` are the logits of 64
items and ``label`` is the target item."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators import dataset as ds
from corpusmill.operators import scores as sc
from corpusmill.plans import sqlhelp as S
from corpusmill.plans.registry import query
from corpusmill.session import table

EVAL_BATCH = 32
RATIO = 0.9
SESSION = 100  # rows per scoring session: the history of a row is its session's earlier targets


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", sc.as_double("embedding").alias("z"), "label")


def _with_history(df):
    w = (Window.partitionBy(F.expr(f"vec_id div {SESSION}")).orderBy("vec_id")
         .rowsBetween(-sc.RECENT_WINDOW, -1))  # bounded: one session
    return df.withColumn("history", F.collect_list("label").over(w))


Z_SQL = "z as (select vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) as z from embeddings)"
LOSS_SQL = f"""{Z_SQL},
zm as (select *, list_max(z) as m from z),
l as (select vec_id, label, m + ln(list_reduce(list_transform(z, lambda x: exp(x - m)), lambda a, b: a + b))
             - z[label + 1] as loss from zm)"""


@query("cross_entropy", f"""with {LOSS_SQL}
select count(*)::BIGINT as n_rows, round(avg(loss), 9) as loss, round(exp(avg(loss)), 6) as perplexity from l""",
       "G1")
def cross_entropy(spark, sf):
    r = sc.mean_cross_entropy(_emb(spark, sf), "z", "label")
    return r.select("n_rows", F.round("loss", 9).alias("loss"), F.round(sc.perplexity(F.col("loss")), 6).alias("perplexity"))


def _split_batches(spark, sf):
    e = ds.dense_index(_emb(spark, sf), "vec_id", "rn")
    n = e.count()
    idx = int(n * RATIO)
    return (e.withColumn("split", F.when(F.col("rn") < idx, "train").otherwise("val"))
            .withColumn("batch", F.when(F.col("rn") < idx, F.expr(f"rn div {EVAL_BATCH}"))
                        .otherwise(F.expr(f"(rn - {idx}) div {EVAL_BATCH}"))))


EST_SQL = f"""{LOSS_SQL},
r as (select *, (row_number() over (order by vec_id) - 1) as rn, floor(count(*) over () * {RATIO}::DOUBLE)::BIGINT as idx from l),
b as (select case when rn < idx then 'train' else 'val' end as split,
             case when rn < idx then rn // {EVAL_BATCH} else (rn - idx) // {EVAL_BATCH} end as batch, avg(loss) as bl
      from r group by all),
e as (select split, avg(bl) as loss, count(*)::BIGINT as n_batches from b group by split)"""


@query("estimate_loss", f"with {EST_SQL} select split, round(loss, 9) as loss, n_batches from e", "G2")
def estimate_loss(spark, sf):
    r = sc.estimate_loss(_split_batches(spark, sf), "z", "label")
    return r.select("split", F.round("loss", 9).alias("loss"), "n_batches")


@query("perplexity", f"""with {EST_SQL}
select split, round(exp(loss), 6) as perplexity, round(exp(least(loss, 20)), 6) as perplexity_capped from e""", "G3")
def perplexity(spark, sf):
    r = sc.estimate_loss(_split_batches(spark, sf), "z", "label")
    return r.select("split", F.round(sc.perplexity(F.col("loss")), 6).alias("perplexity"),
                    F.round(sc.perplexity(F.col("loss"), capped=True), 6).alias("perplexity_capped"))


def _softmax_sql(src: str, col: str) -> str:
    return f"""
sm1 as (select *, list_max({col}) as _m from {src}),
sm2 as (select *, list_transform({col}, lambda x: exp(x - _m)) as _e from sm1),
sm as (select *, list_transform(_e, lambda x: x / list_reduce(_e, lambda a, b: a + b)) as p from sm2)"""


@query("temperature_softmax", f"""with {Z_SQL}, zt as (select vec_id, list_transform(z, lambda x: x / 0.8) as zt from z),
{_softmax_sql('zt', 'zt')}
select vec_id, i::INTEGER as item, round(p[i + 1], 9) as p
from (select vec_id, p, unnest(range(0, len(p))) as i from sm)""", "G4")
def temperature_softmax(spark, sf):
    e = _emb(spark, sf).select("vec_id", sc.temperature_softmax("z", 0.8).alias("p"))
    return e.select("vec_id", F.posexplode("p").alias("item", "p")).select(
        "vec_id", "item", F.round("p", 9).alias("p"))


@query("topk_filter", f"""with {Z_SQL}, k as (select vec_id, z, list_sort(z, 'DESC')[least(5, len(z))] as kth from z)
select vec_id, i::INTEGER as item, round(z[i + 1], 9) as logit
from (select vec_id, z, kth, unnest(range(0, len(z))) as i from k) where z[i + 1] >= kth""", "G5")
def topk_filter(spark, sf):
    e = _emb(spark, sf).select("vec_id", sc.topk_filter("z", 5).alias("f"))
    return (e.select("vec_id", F.posexplode("f").alias("item", "logit"))
            .where(F.col("logit") > float("-inf"))
            .select("vec_id", "item", F.round("logit", 9).alias("logit")))


HIST_SQL = f"""h as (select *, list(label) over (partition by vec_id // {SESSION} order by vec_id
                                            rows between {50} preceding and 1 preceding) as history from z),
hr as (select *, list_distinct(list_slice(coalesce(history, []), greatest(1, len(coalesce(history, [])) - 50 + 1),
                                          len(coalesce(history, [])))) as recent from h)"""


@query("recency_penalty", f"""with {Z_SQL}, {HIST_SQL}
select vec_id, i::INTEGER as item, round(z[i + 1], 9) as logit_before, round(z[i + 1] / 1.2, 9) as logit_after
from (select vec_id, z, recent, unnest(range(0, len(z))) as i from hr) where list_contains(recent, i)""", "G6")
def recency_penalty(spark, sf):
    e = _with_history(_emb(spark, sf))
    p = e.select("vec_id", "z", sc.recency_penalty("z", "history", 1.2).alias("zp"),
                 sc.recent_items("history").alias("recent"))
    return (p.select("vec_id", "recent", F.posexplode(F.arrays_zip("z", "zp")).alias("item", "v"))
            .where(F.array_contains("recent", F.col("item")))
            .select("vec_id", "item", F.round("v.z", 9).alias("logit_before"),
                    F.round("v.zp", 9).alias("logit_after")))


def _draw_sql(src: str, seed: int) -> str:
    u = f"((('0x' || substr(md5(concat_ws(':', {seed}, vec_id)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"
    return f"""
dk as (select vec_id, generate_subscripts(p, 1) as i, unnest(p) as x from {src}),
cs as (select vec_id, i, {u} * sum(x) over (partition by vec_id) as point,
              sum(x) over (partition by vec_id order by i rows between unbounded preceding and current row) as up
       from dk where x > 0)
select vec_id, (coalesce(min(i) filter (where up > point), max(i)) - 1)::INTEGER as item from cs group by vec_id"""


@query("weighted_draw", f"with {Z_SQL}, {_softmax_sql('z', 'z')}, {_draw_sql('sm', 99)[1:]}", "G7")
def weighted_draw(spark, sf):
    e = _emb(spark, sf)
    return e.select("vec_id", sc.weighted_draw(sc.softmax("z"), 99, "vec_id").alias("item"))


@query("next_item", f"""with {Z_SQL}, {HIST_SQL},
t as (select vec_id, list_transform(z, lambda x: x / 0.8) as zt, recent from hr),
pe as (select vec_id, list_transform(zt, lambda x, i: case when list_contains(recent, i - 1) then x / 1.3 else x end)
              as zp from t),
kk as (select vec_id, zp, list_sort(zp, 'DESC')[least(10, len(zp))] as kth from pe),
f as (select vec_id, list_transform(zp, lambda x: case when x >= kth then x else '-inf'::DOUBLE end) as zf from kk),
{_softmax_sql('f', 'zf')}, {_draw_sql('sm', 5)[1:]}""", "G8")
def next_item(spark, sf):
    e = _with_history(_emb(spark, sf))
    return sc.next_items(e, "z", 5, "vec_id", t=0.8, k=10, penalty=1.3, history="history").select("vec_id", "item")
