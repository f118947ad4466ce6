"""Mixing sources to target weights by temperature.

The tokens of a source are its share p of the corpus.  Weights are p^x, normalised;
x is bisected on a fixed grid to the largest value whose weights reach the target
entropy (a share of the logarithm of the number of sources), or, if that would
repeat a source more often than the limit, to the smallest that keeps the limit.
Each source's part of the token budget is then filled with whole epochs and one
part of an epoch.  An epoch is a permutation of blocks and of the documents within
each block, both by keyed hashes; the part of an epoch takes whole blocks in order,
and documents of the one block that the budget cuts, as long as they fit.

Scale: only ids, sources and token counts are shuffled, never texts.  A source may
hold any share of the rows: its rows are dealt out by block (``BLOCK_DOCS`` on
average), the running sum over a source runs over blocks, and the running sum over
documents within one block.  The table of sources is a Spark table throughout; one
row of numbers per bisection step reaches the driver.

Defined results: an empty table gives an empty one.  A null source is a source of its own; a null text has no tokens,
and documents without tokens are dealt out like others.  A source without tokens
gets weight 0 and no document.  Null ids and repeated rows are documents of their
own (equal rows stay neighbours).  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import stored

#: Documents in a block, on average.
BLOCK_DOCS = 1024
#: The exponent is a multiple of ``1 / STEPS``.
STEPS = 1 << 16
#: Inner points that one bisection round tests: five halvings at a time.
_POINTS = 31


def source_tokens(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """``(doc_id, source, n_tokens, tie)``: the words of each document; ``tie`` tells documents apart."""
    tokens = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    tie = F.md5(F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), tokens.alias("n_tokens"), tie.alias("tie"))


def _measures(shares: DataFrame, points: list[int]) -> dict[int, tuple[float, float]]:
    """Entropy over its maximum, and the largest weight over share, at each exponent."""
    grid = shares.select("p", F.explode(F.array(*(F.lit(k) for k in points))).alias("k"))
    power = F.pow("p", F.col("k") / F.lit(STEPS))
    rows = (grid.withColumn("w", power).groupBy("k")
            .agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.ln("p")).alias("s"), F.max(F.col("w") / F.col("p")).alias("top"),
                 F.count("*").alias("n"))
            .select("k", F.round(F.when(F.col("n") == 1, 1.0).otherwise(
                (F.ln("z") - F.col("k") / STEPS * F.col("s") / F.col("z")) / F.ln("n")), 9).alias("entropy"),
                F.round(F.col("top") / F.col("z"), 9).alias("top")).collect())
    return {r.k: (r.entropy, r.top) for r in rows}


def exponent(shares: DataFrame, entropy: float, max_epochs: float, budget_share: float) -> int:
    """The exponent in steps; ``shares`` has a row with the share ``p`` (over 0) of each source.

    Entropy falls and repetition falls as the exponent rises from 0 (equal weights)
    to 1 (as found), so each condition is met on one side of a point.
    """
    def last(holds) -> int:
        """The largest step at which ``holds`` is true; 0 if none is. True up to some step, false beyond."""
        low, high = 0, STEPS + 1
        while high - low > 1:
            points = sorted({low + (high - low) * k // (_POINTS + 1) for k in range(1, _POINTS + 1)} - {low, high})
            got = _measures(shares, points)
            if not got:
                return low  # no source has tokens
            for k in sorted(got):
                if holds(*got[k]):
                    low = k
                else:
                    high = k
                    break
        return low

    by_entropy = last(lambda h, _: h >= entropy)
    too_often = last(lambda _, top: budget_share * top > max_epochs)
    first = _measures(shares, [0])
    least = 0 if not first or budget_share * first[0][1] <= max_epochs else min(too_often + 1, STEPS)
    return max(by_entropy, least)


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", entropy: float = 0.95,
        max_epochs: float = 4.0, budget: int | None = None, block_docs: int = BLOCK_DOCS, seed: str = "mix") -> DataFrame:
    """``(doc_id, source, epoch, block, place, n_tokens)``: each use of a document in the mixture.

    ``budget`` is in tokens (default: the corpus's).  Training reads blocks in the
    order of ``block`` (a hash over all sources) and documents by ``place``.
    """
    rows = stored(source_tokens(docs, doc_id, source, text), "mixing")
    sources = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    wanted = total if budget is None else budget
    shares = stored(sources.where("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(max(total, 1)))), "mixing-shares")
    step = exponent(shares, entropy, max_epochs, wanted / max(total, 1))
    weight = F.pow("p", F.lit(step / STEPS))
    z = shares.agg(F.round(F.sum(weight), 9).alias("z")).first()["z"] or 1.0
    plan = (shares.withColumn("part", F.floor(F.round(weight / F.lit(z) * F.lit(float(wanted)), 3)).cast("long"))
            .withColumn("whole", F.expr("part div tokens"))
            .withColumn("rest", F.expr("part % tokens"))
            .withColumn("blocks", F.ceil(F.col("docs") / F.lit(float(block_docs))).cast("long"))
            .withColumn("epochs", F.col("whole") + F.when(F.col("rest") > 0, 1).otherwise(0))
            .where("epochs > 0").select(F.col("source").alias("of"), "whole", "rest", "blocks", "epochs"))

    def hashed(*parts):
        return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *parts)), 1, 15), 16, 10).cast("long")

    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    # one row of the plan for each source: a skewed join that can be split
    used = (rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
            .withColumn("in_source", F.pmod(hashed(F.lit("deal"), F.col("epoch"), F.col("tie")), F.col("blocks")))
            .withColumn("name", name)
            .withColumn("block", hashed(F.lit("block"), F.col("name"), F.col("epoch"), F.col("in_source")))
            .withColumn("order", hashed(F.lit("place"), F.col("epoch"), F.col("tie"))))
    used = stored(used.select("doc_id", "source", "name", "n_tokens", "tie", "epoch", "whole", "rest", "block", "order"), "mixing-used")
    # the part of an epoch: running sums over its blocks, then over documents of the block that is cut
    sums = (used.where("epoch = whole").groupBy("name", "epoch", "block").agg(F.sum("n_tokens").alias("tokens"), F.max("rest").alias("rest")))
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = (sums.withColumn("left", F.col("rest") - before).where("left > 0").select(
        F.col("name").alias("n2"), F.col("epoch").alias("e2"), F.col("block").alias("b2"), "left"))
    joined = used.join(left, (F.col("name") == F.col("n2")) & (F.col("epoch") == F.col("e2")) & (F.col("block") == F.col("b2")), "left")
    within = Window.partitionBy("name", "epoch", "block").orderBy("order", "tie")
    upto = F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (joined.where("epoch < whole OR left IS NOT NULL").withColumn("place", F.row_number().over(within).cast("long"))
              .withColumn("upto", upto).where("epoch < whole OR upto <= left"))
    return placed.select("doc_id", "source", "epoch", "block", "place", "n_tokens")
