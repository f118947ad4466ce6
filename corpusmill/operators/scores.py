"""Scored-row operators (G1-G8) on a table of logits.

A scored row carries its logits as ``ARRAY<DOUBLE|FLOAT>`` (one element per
vocabulary item, item = 0-based array index).  Every operator is a per-row
array expression, so scoring never shuffles; only the final averages
aggregate (with map-side partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.hashing import md5_unit_fine

PERPLEXITY_CAP = 20.0
RECENT_WINDOW = 50


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(z) -> Column:
    return F.transform(_c(z), lambda x: x.cast("double"))


def _repeat(x: Column, like: Column) -> Column:
    """A row scalar repeated to the length of ``like``: zipping it in keeps
    lambdas free of captured expressions, which would be re-evaluated for
    every element (array functions run outside code generation)."""
    return F.array_repeat(x, F.size(like))


def logsumexp(z) -> Column:
    """Stable log-sum-exp of an array (max subtracted before exponentiating)."""
    z = _c(z)
    m = F.array_max(z)
    e = F.zip_with(z, _repeat(m, z), lambda x, mm: F.exp(x - mm))
    return m + F.log(F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x))


def cross_entropy(z, target) -> Column:
    """Per-row loss ``logsumexp(z) - z[target]`` (G1)."""
    z = as_double(z)
    return logsumexp(z) - F.element_at(z, (_c(target) + 1).cast("int"))


def mean_cross_entropy(df: DataFrame, z: str, target: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(cross_entropy(z, target)).alias("loss"))


def perplexity(loss, capped: bool = False) -> Column:
    """``exp(loss)``; the capped form ``exp(min(loss, 20))`` avoids overflow."""
    loss = _c(loss)
    return F.exp(F.least(loss, F.lit(PERPLEXITY_CAP))) if capped else F.exp(loss)


def estimate_loss(df: DataFrame, z: str, target: str, split: str = "split", batch: str = "batch") -> DataFrame:
    """Per split, the mean of per-batch mean losses."""
    per_batch = (df.groupBy(split, batch).agg(F.avg(cross_entropy(z, target)).alias("_b")))
    return per_batch.groupBy(split).agg(F.avg("_b").alias("loss"), F.count(F.lit(1)).alias("n_batches"))


def temperature(z, t: float) -> Column:
    return F.transform(as_double(z), lambda x: x / F.lit(float(t)))


def softmax(z) -> Column:
    """``exp(z - max) / sum`` per row; ``-inf`` entries get probability 0."""
    z = _c(z)
    e = F.zip_with(z, _repeat(F.array_max(z), z), lambda x, mm: F.exp(x - mm))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.zip_with(e, _repeat(s, e), lambda x, ss: x / ss)


def temperature_softmax(z, t: float) -> Column:
    return softmax(temperature(z, t))


def topk_filter(z, k: int | None) -> Column:
    """Keep logits >= the k-th largest (ties kept), others -> -inf.
    ``k`` is capped at the row size; ``None`` or ``k <= 0`` disables it."""
    z = _c(z)
    if k is None or k <= 0:
        return z
    kth = F.element_at(F.sort_array(z, asc=False), F.least(F.lit(int(k)), F.size(z)))
    return F.zip_with(z, _repeat(kth, z),
                      lambda x, kk: F.when(x >= kk, x).otherwise(F.lit(float("-inf"))))


def recent_items(history, last: int = RECENT_WINDOW) -> Column:
    """Distinct items among the last ``last`` entries of a history array."""
    h = _c(history)
    return F.array_distinct(F.slice(h, F.greatest(F.lit(1), F.size(h) - F.lit(last) + 1), last))


def recency_penalty(z, history, penalty: float, last: int = RECENT_WINDOW) -> Column:
    """Divide the logits of items seen among the last ``last`` history entries
    by ``penalty`` - for either sign of the logit - when ``penalty > 1`` (G6)."""
    z = _c(z)
    if penalty <= 1.0:
        return z
    recent = F.coalesce(recent_items(history, last), F.array().cast("array<int>"))
    zipped = F.arrays_zip(z.alias("v"), _repeat(recent, z).alias("r"),
                          F.sequence(F.lit(0), F.greatest(F.size(z) - 1, F.lit(0))).alias("i"))
    return F.transform(zipped, lambda s: F.when(F.array_contains(s["r"], s["i"]), s["v"] / F.lit(float(penalty)))
                       .otherwise(s["v"]))


def weighted_draw(p, seed: int, row) -> Column:
    """One item drawn with probability proportional to ``p``.

    Inverse distribution: one hashed uniform a row, times the sum of the weights, is searched
    for in the running sums; the item in whose share it falls is drawn.  Items of zero, negative,
    null or NaN weight are never drawn; a row without any other gives null.  Weights are finite.
    """
    def drawn(weights: Column) -> Column:
        share = lambda x: F.when((x > 0) & ~F.isnan(x), x.cast("double")).otherwise(F.lit(0.0))
        total = F.aggregate(weights, F.lit(0.0), lambda up, x: up + share(x))
        # the point is a part of the state: a captured expression would be evaluated for each item
        start = F.struct(F.lit(0.0).alias("up"), (md5_unit_fine(F.lit(seed), _c(row)) * total).alias("point"),
                         F.lit(0).alias("at"), F.lit(-1).alias("item"), F.lit(-1).alias("last"))

        def step(s: Column, x: Column) -> Column:
            has, up = share(x) > 0, s["up"] + share(x)
            return F.struct(up.alias("up"), s["point"].alias("point"), (s["at"] + 1).alias("at"),
                            F.when((s["item"] < 0) & has & (up > s["point"]), s["at"]).otherwise(s["item"]).alias("item"),
                            F.when(has, s["at"]).otherwise(s["last"]).alias("last"))

        # a point that rounds up to the sum itself belongs to the last item
        return F.aggregate(weights, start, step, lambda s: F.when(s["item"] >= 0, s["item"]).when(s["last"] >= 0, s["last"]))

    return F.transform(F.array(_c(p)), drawn)[0]  # one element: the weights are computed once


def next_item(z, seed: int, row, t: float = 1.0, k: int | None = None,
              penalty: float = 1.0, history=None, last: int = RECENT_WINDOW) -> Column:
    """Temperature, recency penalty, top-k, softmax, weighted draw - in that order."""
    x = temperature(z, t)
    if history is not None:
        x = recency_penalty(x, history, penalty, last)
    x = topk_filter(x, k)
    return weighted_draw(softmax(x), seed, row)


def next_items(df: DataFrame, z: str, seed: int, row: str, t: float = 1.0, k: int | None = None,
               penalty: float = 1.0, history: str | None = None, last: int = RECENT_WINDOW,
               out: str = "item") -> DataFrame:
    """``next_item`` as a DataFrame step: each stage is its own projection, so
    every intermediate array is computed once per row (a stage referenced
    several times is not inlined into the next one)."""
    x = df.withColumn("_x", temperature(z, t))
    if history is not None:
        x = x.withColumn("_x", recency_penalty("_x", history, penalty, last))
    x = x.withColumn("_x", topk_filter("_x", k))
    x = x.withColumn("_p", softmax("_x"))
    return x.withColumn(out, weighted_draw("_p", seed, row)).drop("_x", "_p")
