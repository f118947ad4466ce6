"""Queries for run-log analytics (H) and finished-text operators (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.cleaning import python_strip
from corpusmill.operators import runlog as rl
from corpusmill.operators import textops as tx
from corpusmill.operators import vocab as vb
from corpusmill.plans import sqlhelp as S
from corpusmill.plans.registry import query
from corpusmill.session import table

E = 20            # steps per epoch of the test run log
EVERY = 5         # logging interval
TUMBLE = 5
TRAIL = 10
TOKENS_PER_STEP = 64 * 512
RANK_BUCKET = 4096  # small on purpose so the test data spans several buckets per run


def run_log(spark, sf):
    return rl.events_as_run_log(table(spark, sf, "events"), E, RANK_BUCKET)


LOG_SQL = f"""
g as (select user_id as run_id, value as loss, ts,
             row_number() over (partition by user_id order by event_id) as gstep from events),
lg as (select run_id, gstep, ((gstep - 1) // {E} + 1)::INTEGER as epoch, ((gstep - 1) % {E} + 1)::INTEGER as step,
              loss, ts,
              coalesce((epoch_us(ts) - epoch_us(lag(ts) over (partition by run_id order by gstep))) / 1e6, 0.0)
              as secs from g)"""


def _r(c, d=9):
    return F.round(c, d)


@query("run_log", f"with {LOG_SQL} select run_id, gstep, epoch, step, round(loss, 9) as loss, round(secs, 6) as secs from lg",
       "H")
def run_log_q(spark, sf):
    return run_log(spark, sf).select("run_id", "gstep", "epoch", "step", _r("loss").alias("loss"),
                                     _r("secs", 6).alias("secs"))


@query("running_mean", f"""with {LOG_SQL}
select run_id, epoch, step, round(avg_loss, 9) as avg_loss from (
  select *, avg(loss) over (partition by run_id, epoch order by step rows between unbounded preceding and current row)
         as avg_loss from lg) where step % {EVERY} = 0""", "H1")
def running_mean(spark, sf):
    r = rl.running_mean(run_log(spark, sf), EVERY)
    return r.withColumn("avg_loss", _r("avg_loss"))


@query("tumbling_mean", f"""with {LOG_SQL}
select run_id, epoch, ((step - 1) // {TUMBLE})::BIGINT as block, round(avg(loss), 9) as avg_loss, max(step) as step
from lg group by all having count(*) = {TUMBLE}""", "H2")
def tumbling_mean(spark, sf):
    r = rl.tumbling_mean(run_log(spark, sf), TUMBLE)
    return r.withColumn("avg_loss", _r("avg_loss"))


TRAIL_SQL = f"""tr as (select *, avg(secs) over (partition by run_id, epoch order by step
                                              rows between {TRAIL - 1} preceding and current row) as avg_step from lg)"""


@query("trailing_mean", f"with {LOG_SQL}, {TRAIL_SQL} select run_id, epoch, step, round(avg_step, 3) as avg_step_secs from tr",
       "H3")
def trailing_mean(spark, sf):
    log = run_log(spark, sf)
    return log.select("run_id", "epoch", "step", _r(rl.trailing_mean("secs", TRAIL), 3).alias("avg_step_secs"))


@query("throughput", f"""with {LOG_SQL}, {TRAIL_SQL}
select run_id, epoch, step, round(case when avg_step > 0 then 1.0 / avg_step else 0 end, 9) as steps_per_sec,
       round(case when avg_step > 0 then 1.0 / avg_step else 0 end * {float(TOKENS_PER_STEP)}, 6) as tokens_per_sec
from tr where step % {EVERY} = 0""", "H4")
def throughput(spark, sf):
    log = run_log(spark, sf).withColumn("avg_step", rl.trailing_mean("secs", TRAIL))
    sps, tps = rl.throughput(F.col("avg_step"), TOKENS_PER_STEP)
    return (log.where(F.col("step") % EVERY == 0)
            .select("run_id", "epoch", "step", _r(sps).alias("steps_per_sec"), _r(tps, 6).alias("tokens_per_sec")))


EPOCH_SQL = f"""ep as (select run_id, epoch, avg(loss) as avg_loss, sum(secs) as duration_secs, avg(secs) as avg_step_secs,
                    count(*)::BIGINT as steps, exp(least(avg(loss), 20)) as perplexity from lg group by all)"""


@query("epoch_summary", f"""with {LOG_SQL}, {EPOCH_SQL}
select run_id, epoch, round(avg_loss, 9) as avg_loss, round(duration_secs, 3) as duration_secs,
       round(avg_step_secs, 3) as avg_step_secs, steps, round(perplexity, 6) as perplexity from ep""", "H5")
def epoch_summary(spark, sf):
    s = rl.epoch_summary(run_log(spark, sf))
    return s.select("run_id", "epoch", _r("avg_loss").alias("avg_loss"), _r("duration_secs", 3).alias("duration_secs"),
                    _r("avg_step_secs", 3).alias("avg_step_secs"), "steps", _r("perplexity", 6).alias("perplexity"))


@query("run_summary", f"""with {LOG_SQL}, {EPOCH_SQL}
select run_id, count(*)::BIGINT as epochs_completed, round(arg_max(avg_loss, epoch), 9) as last_loss,
       round(min(avg_loss), 9) as best_loss, arg_min(epoch, (avg_loss, epoch))::INTEGER as best_epoch
from ep group by run_id""", "H6")
def run_summary(spark, sf):
    s = rl.run_summary(rl.epoch_summary(run_log(spark, sf)))
    return s.select("run_id", "epochs_completed", _r("last_loss").alias("last_loss"),
                    _r("best_loss").alias("best_loss"), "best_epoch")


@query("pace", f"""with {LOG_SQL}
select run_id, epoch, step, round(elapsed, 3) as elapsed, round(elapsed / step, 3) as secs_per_step,
       round(({E} - step) * (elapsed / step) / 60.0, 3) as eta_minutes
from (select *, sum(secs) over (partition by run_id, epoch order by step rows between unbounded preceding and current row)
             as elapsed from lg) where step % {EVERY} = 0""", "H7")
def pace(spark, sf):
    p = rl.pace(run_log(spark, sf), E, EVERY)
    return p.select("run_id", "epoch", "step", _r("elapsed", 3).alias("elapsed"),
                    _r("secs_per_step", 3).alias("secs_per_step"), _r("eta_minutes", 3).alias("eta_minutes"))


@query("resume_history", f"""with {LOG_SQL}, {EPOCH_SQL},
st as (select run_id, epoch, avg_loss from ep where epoch <= 2),
nw as (select run_id, epoch, avg_loss from ep where epoch >= 2),
lst as (select run_id, max(epoch) as last from st group by run_id)
select run_id, epoch, round(avg_loss, 9) as avg_loss from (
  select * from st union all
  select nw.run_id, nw.epoch, nw.avg_loss from nw left join lst using (run_id) where nw.epoch > coalesce(lst.last, 0))""",
       "H8")
def resume_history(spark, sf):
    ep = rl.epoch_summary(run_log(spark, sf)).select("run_id", "epoch", "avg_loss")
    out = rl.resume_history(ep.where("epoch <= 2"), ep.where("epoch >= 2"))
    return out.withColumn("avg_loss", _r("avg_loss"))


@query("basic_aggregates", """
select event_type, round(sum(value), 6) as total, count(*) filter (where value > 50)::BIGINT as n_high,
       round(avg(value * 2 + 1), 9) as affine_mean, round(sum(case when value > 50 then value else 0 end), 6) as high_total
from events group by event_type""", "H9")
def basic_aggregates(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("event_type").agg(
        _r(F.sum("value"), 6).alias("total"), F.count_if(F.col("value") > 50).alias("n_high"),
        _r(F.avg(F.col("value") * 2 + 1)).alias("affine_mean"),
        _r(F.sum(F.when(F.col("value") > 50, F.col("value")).otherwise(F.lit(0.0))), 6).alias("high_total"))


# ---- I: finished text ------------------------------------------------------------------------

ROLE_LABEL = {"user": "User", "assistant": "Assistant", "system": "System"}


def completions(spark, sf):
    """One completion per user turn: the turn and the two that follow, rendered
    ``Role: text`` one per line; the prompt is the rendered user turn.  Turns
    are joined on ``(conv_id, turn)``, so no conversation is gathered whole."""
    conv = table(spark, sf, "conversations")
    label = F.coalesce(*[F.when(F.col("role") == k, F.lit(v)) for k, v in ROLE_LABEL.items()], F.initcap("role"))
    r = conv.select("conv_id", "turn", "role", F.concat(label, F.lit(": "), F.col("text")).alias("r"))
    nxt1 = r.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("r").alias("r1"))
    nxt2 = r.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("r").alias("r2"))
    u = r.where(F.col("role") == "user")
    return (u.join(nxt1, ["conv_id", "turn"], "left").join(nxt2, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", F.col("r").alias("prompt"), F.concat_ws("\n", "r", "r1", "r2").alias("text")))


def _label_sql(col):
    cases = " ".join(f"when {col} = '{k}' then '{v}'" for k, v in ROLE_LABEL.items())
    return f"(case {cases} else upper(substr({col}, 1, 1)) || lower(substr({col}, 2)) end)"


COMPLETIONS_SQL = f"""
r as (select conv_id, turn, role, {_label_sql('role')} || ': ' || text as r from conversations),
cmp as (select u.conv_id, u.turn, u.r as prompt, concat_ws(chr(10), u.r, a.r, b.r) as text
        from r u left join r a on a.conv_id = u.conv_id and a.turn = u.turn + 1
                 left join r b on b.conv_id = u.conv_id and b.turn = u.turn + 2
        where u.role = 'user')"""


def _stop_sql():
    cands = []
    for j, s in enumerate(tx.DEFAULT_STOPS):
        pos = f"(case when strpos(substr(text, length(prompt) + 1), {S.sql_chars(s)}) > 0 then " \
              f"strpos(substr(text, length(prompt) + 1), {S.sql_chars(s)}) + length(prompt) end)"
        cands.append(f"{{'end': {pos} + {len(s) - 1}, 'idx': {j}, 'pos': {pos}}}")
    return "list_min(list_filter([" + ", ".join(cands) + "], lambda x: x['pos'] is not null))"


@query("truncate_at_stop", f"""with {COMPLETIONS_SQL},
h as (select conv_id, turn, prompt, text, {_stop_sql()} as hit from cmp)
select conv_id, turn, trim(case when hit is not null then substr(text, 1, hit['pos'] - 1) else text end, {S.ws_set()})
       as finished, hit['idx'] as stop_idx from h""", "I1")
def truncate_at_stop(spark, sf):
    c = completions(spark, sf)
    hit = tx.first_stop(F.col("text"), F.col("prompt"))
    return c.select("conv_id", "turn", tx.truncate_at_stop(F.col("text"), F.col("prompt")).alias("finished"),
                    hit["idx"].alias("stop_idx"))


def _prompt_variants(spark, sf):
    conv = table(spark, sf, "conversations")
    return (conv.select("conv_id", "turn", F.lit("text").alias("variant"), F.col("text").alias("prompt"))
            .unionByName(conv.select("conv_id", "turn", F.lit("blank").alias("variant"),
                                     F.regexp_replace("text", "\\S", " ").alias("prompt")))
            .unionByName(conv.select("conv_id", "turn", F.lit("non_ascii").alias("variant"),
                                     F.regexp_replace("text", "[\\x{0}-\\x{7F}]", "").alias("prompt"))))


@query("prompt_guard", f"""
with v as ({S.vocab_sql('benchmark')}),
p as (select conv_id, turn, 'text' as variant, text as prompt from conversations
      union all select conv_id, turn, 'blank', regexp_replace(text, '\\S', ' ', 'g') from conversations
      union all select conv_id, turn, 'non_ascii', regexp_replace(text, '[\\x{{0}}-\\x{{7F}}]', '', 'g') from conversations),
k as (select conv_id, turn, variant, count(*) as n_known
      from (select conv_id, turn, variant, unnest(string_split(prompt, '')) as ch from p) join v using (ch) group by all)
select conv_id, turn, variant,
  case when trim(prompt, {S.ws_set()}) = '' then '{tx.MSG_EMPTY}'
       when coalesce(n_known, 0) = 0 then '{tx.MSG_UNENCODABLE}' end as reason,
  case when prompt = '' then chr(10) else prompt end = chr(10) as starts_from_newline
from p left join k using (conv_id, turn, variant)""", "I2+I3")
def prompt_guard(spark, sf):
    codec = vb.CharCodec(vb.char_vocab(table(spark, sf, "benchmark")))
    p = _prompt_variants(spark, sf)
    return p.select("conv_id", "turn", "variant",
                    tx.prompt_guard(F.col("prompt"), codec.encode(F.col("prompt"))).alias("reason"),
                    (tx.default_prompt(F.col("prompt")) == "\n").alias("starts_from_newline"))
