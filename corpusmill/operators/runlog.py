"""Run-log analytics (H1-H9) over a table of training steps.

A run log is ``(run_id, gstep, epoch, step, loss, ts, secs)``: ``gstep`` counts
steps over the whole run, ``step`` restarts each epoch.  Epochs hold a bounded
number of steps, so every per-step window is partitioned by ``(run_id, epoch)``
and stays small even when one run holds a third of all rows.  Numbering the
steps of a run is done without a window over the whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.scores import PERPLEXITY_CAP

DEFAULT_RANK_BUCKET = 1 << 20


def rank_within(df: DataFrame, part: str, order: str, out: str = "rank",
                bucket_width: int = DEFAULT_RANK_BUCKET) -> DataFrame:
    """1-based rank of ``order`` (unique per ``part``) inside ``part``.

    Rows are ranked inside ``(part, order div bucket_width)`` - a bounded
    group - and shifted by the number of rows of the same ``part`` in earlier
    buckets (a running sum over the per-bucket counts).  A hot ``part`` is
    spread over many buckets instead of landing in one task.
    """
    b = df.withColumn("_rb", F.expr(f"{order} div {int(bucket_width)}"))
    inner = Window.partitionBy(part, "_rb").orderBy(order)
    b = b.withColumn("_rin", F.row_number().over(inner))
    counts = b.groupBy(part, "_rb").agg(F.count(F.lit(1)).alias("_rc"))
    outer = Window.partitionBy(part).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(part, "_rb", F.coalesce(F.sum("_rc").over(outer), F.lit(0)).alias("_roff"))
    return (b.join(offs, [part, "_rb"])
            .withColumn(out, (F.col("_roff") + F.col("_rin")).cast("bigint"))
            .drop("_rb", "_rin", "_roff"))


def events_as_run_log(events: DataFrame, steps_per_epoch: int, bucket_width: int = DEFAULT_RANK_BUCKET) -> DataFrame:
    """Read ``events`` as a run log: ``user_id`` is the run, the rank of
    ``event_id`` inside the run is the global step, ``value`` the loss.
    ``secs`` is the time since the run's previous step (0 for its first)."""
    e = events.select(F.col("user_id").alias("run_id"), "event_id", F.col("value").alias("loss"), "ts")
    r = rank_within(e, "run_id", "event_id", "gstep", bucket_width)
    prev = r.select("run_id", (F.col("gstep") + 1).alias("gstep"), F.col("ts").alias("_prev_ts"))
    r = r.join(prev, ["run_id", "gstep"], "left")  # equi-join on (run, step): no hot key
    E = int(steps_per_epoch)
    return r.select(
        "run_id", "gstep",
        (F.expr(f"(gstep - 1) div {E}") + 1).cast("int").alias("epoch"),
        (F.expr(f"(gstep - 1) % {E}") + 1).cast("int").alias("step"),
        "loss", "ts",
        F.coalesce((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_prev_ts").cast("timestamp")))
                   / F.lit(1e6), F.lit(0.0)).alias("secs"))


def _epoch_window() -> Window:
    return Window.partitionBy("run_id", "epoch").orderBy("step")


def running_mean(log: DataFrame, every: int = 100) -> DataFrame:
    """Cumulative mean loss inside the epoch, emitted every ``every`` steps (H1)."""
    w = _epoch_window().rowsBetween(Window.unboundedPreceding, 0)
    return (log.withColumn("avg_loss", F.avg("loss").over(w))
            .where(F.col("step") % every == 0)
            .select("run_id", "epoch", "step", "avg_loss"))


def tumbling_mean(log: DataFrame, n: int = 50) -> DataFrame:
    """Mean loss of each full block of ``n`` steps; the counter resets (H2)."""
    return (log.groupBy("run_id", "epoch", F.expr(f"(step - 1) div {int(n)}").alias("block"))
            .agg(F.avg("loss").alias("avg_loss"), F.count(F.lit(1)).alias("_n"), F.max("step").alias("step"))
            .where(F.col("_n") == n).drop("_n"))


def trailing_mean(col: str, n: int) -> Column:
    """Mean of the last ``min(n, seen)`` values inside the epoch (H3)."""
    return F.avg(col).over(_epoch_window().rowsBetween(-(int(n) - 1), 0))


def throughput(avg_step_time: Column, tokens_per_step: int) -> tuple[Column, Column]:
    """Steps per second and tokens per second, 0 when the time is not positive (H4)."""
    sps = F.when(avg_step_time > 0, F.lit(1.0) / avg_step_time).otherwise(F.lit(0.0))
    return sps, sps * F.lit(float(tokens_per_step))


def epoch_summary(log: DataFrame) -> DataFrame:
    """Mean loss, capped perplexity, duration and mean step time per epoch (H5)."""
    return (log.groupBy("run_id", "epoch")
            .agg(F.avg("loss").alias("avg_loss"), F.sum("secs").alias("duration_secs"),
                 F.avg("secs").alias("avg_step_secs"), F.count(F.lit(1)).alias("steps"))
            .withColumn("perplexity", F.exp(F.least(F.col("avg_loss"), F.lit(PERPLEXITY_CAP)))))


def epoch_losses(log: DataFrame, steps_per_epoch: int, train_steps: int, complete_only: bool = True) -> DataFrame:
    """Mean training and validation loss of each epoch: steps up to ``train_steps`` are
    training.  A history has completed epochs: with ``complete_only`` one of fewer than
    ``steps_per_epoch`` steps (a run's last, still going on) is left out; without it
    stays, its validation loss null if no such step was made."""
    out = (log.groupBy("run_id", "epoch")
           .agg(F.avg(F.when(F.col("step") <= train_steps, F.col("loss"))).alias("train_loss"),
                F.avg(F.when(F.col("step") > train_steps, F.col("loss"))).alias("val_loss"),
                F.count(F.lit(1)).alias("_steps")))
    return (out.where(F.col("_steps") == steps_per_epoch) if complete_only else out).drop("_steps")


def run_summary(epochs: DataFrame, loss: str = "avg_loss") -> DataFrame:
    """Last and best loss per run and the first epoch reaching the best (H6)."""
    return epochs.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("epochs_completed"),
        F.max_by(loss, "epoch").alias("last_loss"),
        F.min(loss).alias("best_loss"),
        F.min_by("epoch", F.struct(F.col(loss), F.col("epoch"))).alias("best_epoch"))


def pace(log: DataFrame, steps_per_epoch: int, every: int = 100) -> DataFrame:
    """At every ``every``-th step: seconds per step so far in the epoch and the
    estimated minutes left in it (H7)."""
    w = _epoch_window().rowsBetween(Window.unboundedPreceding, 0)
    x = log.withColumn("elapsed", F.sum("secs").over(w))
    return (x.where(F.col("step") % every == 0)
            .select("run_id", "epoch", "step", "elapsed",
                    (F.col("elapsed") / F.col("step")).alias("secs_per_step"),
                    ((F.lit(steps_per_epoch) - F.col("step")) * (F.col("elapsed") / F.col("step")) / 60.0)
                    .alias("eta_minutes")))


def resume_history(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Append the epochs of a resumed run after the stored ones: new epochs
    at or below a run's stored maximum are dropped (H8)."""
    last = stored.groupBy("run_id").agg(F.max("epoch").alias("_last"))
    fresh = (new.join(last, "run_id", "left")
             .where(F.col("epoch") > F.coalesce(F.col("_last"), F.lit(0))).drop("_last"))
    return stored.unionByName(fresh)
