"""Cleaning of whole tables and the profile numbers around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import cleaning as cl

# --- fixed values: cut points and wording of the cleaning recommendation -------
RECOMMENDATION_RULES = [
    # (upper bound exclusive, should_clean, mode, reason)
    (300, False, None, "Vocabulary size is already optimal"),
    (500, False, None, "Vocabulary size is acceptable"),
    (1000, True, "balanced", "Moderate vocabulary - balanced cleaning recommended"),
    (3000, True, "balanced", "Large vocabulary - balanced cleaning recommended"),
    (None, True, "strict", "Very large vocabulary - strict cleaning recommended"),
]
SHOULD_CLEAN_THRESHOLD = 500
# -------------------------------------------------------------------------------


def clean_table(df: DataFrame, mode: str = "balanced", text_col: str = "text",
                out_col: str = "cleaned") -> DataFrame:
    """Add the cleaned text as a column; every other column passes through."""
    return df.withColumn(out_col, cl.clean(F.col(text_col), mode))


def _pct(removed: Column, total: Column) -> Column:
    return F.when(total > 0, removed / total * 100.0).otherwise(F.lit(0.0))


def clean_corpus_totals(df: DataFrame, mode: str = "balanced", text_col: str = "text") -> DataFrame:
    """One row: characters in, characters out, percent removed (0 when empty)."""
    c = cl.clean(F.col(text_col), mode)
    agg = df.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("chars_in"),
                 F.coalesce(F.sum(F.length(c)), F.lit(0)).alias("chars_out"))
    return agg.select("chars_in", "chars_out",
                      F.when(F.col("chars_in") > 0,
                             (1 - F.col("chars_out") / F.col("chars_in")) * 100.0)
                      .otherwise(F.lit(0.0)).alias("pct_removed"))


def char_array(c) -> Column:
    """One element per code point; empty text gives an empty array."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(col, ""), lambda x: x != "")


def distinct_chars(df: DataFrame, text_col: str = "text", by: list[str] | None = None) -> DataFrame:
    """Distinct characters (per group).  Each row is reduced to its own distinct
    set before exploding, so the exploded volume is bounded by the alphabet of
    each row, and the map-side aggregate bounds what is shuffled."""
    by = list(by or [])
    return (df.select(*by, F.explode(F.array_distinct(char_array(text_col))).alias("ch"))
            .distinct())


def cleaning_stats(df: DataFrame, mode: str = "balanced", text_col: str = "text",
                   by: list[str] | None = None) -> DataFrame:
    """Characters and distinct characters before and after cleaning, removed
    counts and percentage reductions, optionally per group (C2).

    One pass: each row yields its two lengths and its distinct characters
    tagged by side; one explode (the lengths ride on the first element) and
    one aggregate give every number, so the cleaning runs once per row.
    """
    by = list(by or [])
    before, after = F.col("_before"), F.col("_after")
    # a column of its own: array functions would each clean the text again
    both = df.select(*by, F.col(text_col).alias("_before"), cl.clean(F.col(text_col), mode).alias("_after"))

    def tagged(c, side):
        return F.transform(F.array_distinct(char_array(c)), lambda ch: F.struct(F.lit(side).alias("s"), ch.alias("c")))

    rows = both.select(*by, F.length(before).alias("_lb"), F.length(after).alias("_la"),
                     F.concat(tagged(before, 0), tagged(after, 1)).alias("_t"))
    flat = rows.select(*by, "_lb", "_la", F.posexplode_outer("_t").alias("_pos", "_e"))
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    agg = flat.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(first, F.col("_lb"))), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum(F.when(first, F.col("_la"))), F.lit(0)).alias("chars_after"),
        F.count_distinct(F.when(F.col("_e.s") == 0, F.col("_e.c"))).alias("vocab_before"),
        F.count_distinct(F.when(F.col("_e.s") == 1, F.col("_e.c"))).alias("vocab_after"))
    return agg.select(
        *by, "chars_before", "chars_after", "vocab_before", "vocab_after",
        (F.col("chars_before") - F.col("chars_after")).alias("chars_removed"),
        _pct(F.col("chars_before") - F.col("chars_after"), F.col("chars_before")).alias("pct_chars_removed"),
        (F.col("vocab_before") - F.col("vocab_after")).alias("vocab_reduced"),
        _pct(F.col("vocab_before") - F.col("vocab_after"), F.col("vocab_before")).alias("pct_vocab_reduced"))


def should_clean(vocab_size, threshold: int = SHOULD_CLEAN_THRESHOLD) -> Column:
    """Strictly greater than the threshold."""
    v = F.col(vocab_size) if isinstance(vocab_size, str) else vocab_size
    return v > F.lit(threshold)


def cleaning_recommendation(vocab_size) -> Column:
    """struct(should_clean, mode, reason) from half-open cut points (C4)."""
    v = F.col(vocab_size) if isinstance(vocab_size, str) else vocab_size
    should = mode = reason = None
    for bound, s, m, r in reversed(RECOMMENDATION_RULES):
        if bound is None:
            should, mode, reason = F.lit(s), F.lit(m).cast("string"), F.lit(r)
            continue
        cond = v < F.lit(bound)
        should = F.when(cond, F.lit(s)).otherwise(should)
        mode = F.when(cond, F.lit(m).cast("string")).otherwise(mode)
        reason = F.when(cond, F.lit(r)).otherwise(reason)
    return F.struct(should.alias("should_clean"), mode.alias("mode"), reason.alias("reason"))
