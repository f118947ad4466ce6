"""Token dataset assembly.

The token table is ``(doc_id, ids ARRAY<INT>)``: one row per document in
document order.  Global positions come from a two-level prefix sum over keys and
sizes only (per key range bucket, then a bounded table of bucket offsets), never
from a window over all documents or over their tokens.  Training windows are read from fixed-size token blocks
with an equi-join on the block number instead of a range join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.hashing import md5_bits, md5_unit
from corpusmill.session import scratch_path

#: Keys in one range of the two-level prefix sum, on average, and ranges at most:
#: beyond their product ranges grow, holding two narrow columns.
BUCKET_KEYS = 100_000
MOST_BUCKETS = 1024


# ---- F1: global offsets ------------------------------------------------------------

def prefix_offsets(df: DataFrame, key: str, size: Column | str, out: str = "start_pos",
                   bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Exclusive running sum of ``size`` in ``key`` order (a null key first), in two levels.

    ``key`` is of any type that can be ordered: numbers, strings, dates, structs.  Only
    ``(key, size)`` is sorted: once, by ranges of sampled keys, into a table that says
    which range each row is in.  Sums run inside the ranges; the ranges' totals (at most
    ``MOST_BUCKETS`` rows) get a running sum of their own and are broadcast back.  The
    result joins back by key, so payload columns never pass through a window.  Keys must
    be unique; a repeated one is an error.
    """
    size = F.col(size) if isinstance(size, str) else size
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "sizes")
    df.select(F.col(key).alias("_k"), size.cast("bigint").alias("_n")).write.parquet(path)
    narrow = spark.read.parquet(path)
    many = min(MOST_BUCKETS, max(1, math.ceil(narrow.count() / bucket_keys)))
    ranged = f"{path}-ranges"
    # equal keys are in one range; the range that a row was written in is a column from then on
    (narrow.repartitionByRange(many, F.col("_k").asc_nulls_first()).withColumn("_b", F.spark_partition_id()).write.parquet(ranged))
    keyed = spark.read.parquet(ranged)
    inner = Window.partitionBy("_b").orderBy(F.col("_k").asc_nulls_first())
    again = F.lag("_k").over(inner).eqNullSafe(F.col("_k")) & (F.row_number().over(inner) > 1)
    unique = F.when(again, F.raise_error(F.concat(F.lit("repeated key "), F.coalesce(F.to_json(F.struct("_k")), F.lit("null")))).cast("bigint"))
    b = keyed.withColumn("_in", F.coalesce(unique, F.sum("_n").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")))
    totals = keyed.groupBy("_b").agg(F.sum("_n").alias("_bn"))
    outer = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)  # <= MOST_BUCKETS rows
    offs = totals.select("_b", (F.sum("_bn").over(outer) - F.col("_bn")).alias("_boff"))
    starts = b.join(F.broadcast(offs), "_b").select("_k", (F.col("_boff") + F.col("_in")).alias(out))
    return df.join(starts, df[key].eqNullSafe(F.col("_k"))).drop("_k")


def token_offsets(tokens: DataFrame, key: str = "doc_id", ids: str = "ids",
                  bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Adds ``n_tokens`` and ``start_pos`` (global position of the first token).

    The token table is written once, so what makes the tokens runs once."""
    path = scratch_path(tokens.sparkSession, "tokens")
    tokens.withColumn("n_tokens", F.size(ids).cast("bigint")).write.parquet(path)
    return prefix_offsets(tokens.sparkSession.read.parquet(path), key, "n_tokens", "start_pos", bucket_keys)


def token_stream(tokens_off: DataFrame, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Flat view ``(doc_id, pos, id)`` of the concatenated stream."""
    return tokens_off.select(key, F.col("start_pos"), F.posexplode(ids).alias("i", "id")) \
        .select(key, (F.col("start_pos") + F.col("i")).alias("pos"), "id")


def dense_index(df: DataFrame, key: str, out: str = "row_index", bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """0-based rank of each row in ``key`` order (keys unique), without a global window."""
    return prefix_offsets(df, key, F.lit(1), out, bucket_keys)


# ---- F2: positional split -----------------------------------------------------------

def split_index(total: Column, ratio: float = 0.9) -> Column:
    """``int(total * ratio)``: double product, truncated."""
    return (total.cast("double") * F.lit(float(ratio))).cast("bigint")


def split_documents(tokens_off: DataFrame, index: int, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows ``(split, doc_id, start_pos, ids)``: positions below ``index`` are
    train, the rest val; a document straddling the index is cut in two."""
    n = F.col("n_tokens")
    s = F.col("start_pos")
    k = F.least(F.greatest(F.lit(index) - s, F.lit(0)), n)  # tokens of this doc in train
    train = F.struct(F.lit("train").alias("split"), s.alias("start_pos"), F.lit(1).alias("first"), k.cast("int").alias("many"))
    val = F.struct(F.lit("val").alias("split"), (s + k).alias("start_pos"), (k + 1).cast("int").alias("first"), (n - k).cast("int").alias("many"))
    # both parts in one pass over the tokens
    part = tokens_off.select(key, ids, F.explode(F.array(train, val)).alias("_p")).where("_p.many > 0")
    return part.select(F.col("_p.split").alias("split"), key, F.col("_p.start_pos").alias("start_pos"),
                       F.slice(ids, F.col("_p.first"), F.col("_p.many")).alias(ids))


# ---- token blocks (layout used by F3, F4, F6) ----------------------------------------

def token_blocks(tokens_off: DataFrame, block_len: int, ids: str = "ids",
                 only: DataFrame | None = None, overlap: int = 0, ranged: bool = False) -> DataFrame:
    """``(block, ids)``: the stream cut into consecutive blocks of ``block_len``
    tokens (the last one may be shorter), each followed by the next block's first
    ``overlap`` tokens.  Each document contributes one piece per block it overlaps; a
    block gathers at most ``block_len + overlap`` tokens.  ``only`` (a table of block
    numbers) restricts the layout to those blocks before any token is copied or shuffled.
    With ``ranged`` the one shuffle deals blocks out by ranges, for ``write_blocks(ranged=True)``."""
    L = int(block_len)
    s, n = F.col("start_pos"), F.col("n_tokens")
    first = F.greatest(F.floor((s - overlap) / L), F.lit(0)).cast("bigint")
    pieces = (tokens_off.where(n > 0)
              .select(s, n, ids, F.explode(F.sequence(first, F.floor((s + n - 1) / L).cast("bigint"))).alias("block")))
    if only is not None:
        pieces = pieces.join(only.select("block").distinct(), "block", "left_semi")
    pieces = (pieces
              .withColumn("_from", F.greatest(F.col("block") * L - s, F.lit(0)))
              .withColumn("_to", F.least((F.col("block") + 1) * L + overlap - s, n))
              .select("block", (s + F.col("_from")).alias("_p"),
                      F.slice(ids, (F.col("_from") + 1).cast("int"), (F.col("_to") - F.col("_from")).cast("int"))
                      .alias("_piece")))
    if ranged:
        pieces = pieces.repartitionByRange("block")
    return (pieces.groupBy("block")
            .agg(F.array_sort(F.collect_list(F.struct("_p", "_piece"))).alias("_ps"))
            .select("block", F.flatten(F.transform("_ps", lambda x: x["_piece"])).alias(ids)))


def write_blocks(blocks: DataFrame, path: str, partitions: int | None = None, row_group_bytes: int = 1 << 20, ranged: bool = False) -> None:
    """Keeps a block table for random reads: sorted by block number, in small row groups,
    so that a read of some blocks leaves out files, row groups and pages by their statistics.
    Blocks that come by ranges (``ranged``) are not shuffled again."""
    order = F.col("block").asc()
    t = blocks if ranged else blocks.repartitionByRange(partitions, order) if partitions else blocks.repartitionByRange(order)
    t.sortWithinPartitions("block").write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", row_group_bytes >> 4).parquet(path)


def read_blocks(spark: SparkSession, path: str, starts: DataFrame | None = None, block_len: int = 0, ranges: int = 64) -> DataFrame:
    """A block table kept by ``write_blocks``.

    With ``starts`` (a table of window starts, bounded by its parameters) only blocks
    that the windows need: their numbers, put together in up to ``ranges`` intervals, are
    a filter on the scan."""
    blocks = spark.read.parquet(path)
    if starts is None:
        return blocks
    need = sorted(r["block"] for r in needed_blocks(starts, block_len).distinct().collect())
    if not need:
        return blocks.where(F.lit(False))
    # the widest gaps stay open
    gaps = sorted(sorted(range(1, len(need)), key=lambda k: need[k - 1] - need[k])[:ranges - 1])
    wanted = F.lit(False)
    for lo, hi in zip([0, *gaps], [*gaps, len(need)], strict=True):
        wanted = wanted | F.col("block").between(need[lo], need[hi - 1])
    return blocks.where(wanted)


# ---- F3 / F4: window sampling --------------------------------------------------------

def window_starts(spark: SparkSession, lo: int, hi: int, seq_len: int, batch_size: int,
                  batches: int, seed: int, split: str = "train", sort: bool = True) -> DataFrame:
    """Starts drawn uniformly with replacement from ``[lo, hi - seq_len - 1)``.

    ``slot`` is the rank of the start inside its batch when ``sort`` (the
    pre-training sampler sorts), else the draw order (the fine-tuning sampler).
    """
    top = hi - seq_len - 1
    if top <= lo:
        raise ValueError(f"no window of length {seq_len} fits in [{lo}, {hi})")
    draws = spark.range(batches * batch_size).select(
        F.lit(split).alias("split"),
        (F.col("id") / batch_size).cast("bigint").alias("batch"),
        (F.col("id") % batch_size).alias("draw"))
    draws = draws.withColumn(
        "start", F.lit(lo) + F.floor(md5_unit(F.lit(seed), "split", "batch", "draw") * F.lit(top - lo)).cast("bigint"))
    if sort:
        w = Window.partitionBy("split", "batch").orderBy("start", "draw")  # bounded by batch_size
        draws = draws.withColumn("slot", (F.row_number().over(w) - 1).cast("bigint"))
    else:
        draws = draws.withColumn("slot", F.col("draw"))
    return draws


def needed_blocks(starts: DataFrame, block_len: int) -> DataFrame:
    """The two block numbers every window start reads."""
    first = F.expr(f"start div {int(block_len)}")
    return starts.select(F.explode(F.array(first, first + 1)).alias("block"))


def sample_windows(blocks: DataFrame, starts: DataFrame, seq_len: int, block_len: int) -> DataFrame:
    """x = tokens [start, start+L), y = tokens [start+1, start+L] for every start.

    ``block_len >= seq_len + 1`` keeps every window inside two consecutive
    blocks, so starts and blocks meet in an equi-join on the block number.
    """
    L, B = int(seq_len), int(block_len)
    if B < L + 1:
        raise ValueError("block_len must be at least seq_len + 1")
    first = F.expr(f"start div {B}")
    need = starts.select("*", F.explode(F.array(first, first + 1)).alias("block"))
    got = blocks.join(need, "block")
    keys = ["split", "batch", "slot", "start"]
    win = (got.groupBy(*keys)
           .agg(F.array_sort(F.collect_list(F.struct("block", "ids"))).alias("_bs"))
           .select(*keys, F.flatten(F.transform("_bs", lambda x: x["ids"])).alias("_t"),
                   (F.col("start") - F.element_at("_bs", 1)["block"] * B).alias("_off")))
    seq = F.slice("_t", (F.col("_off") + 1).cast("int"), L + 1)
    return win.select(*keys, F.slice(seq, 1, L).alias("x"), F.slice(seq, 2, L).alias("y"))


# ---- F5: dataset plan ------------------------------------------------------------------

def dataset_plan(manifest: DataFrame, seq_len: int, batch_size: int, epochs: int = 1,
                 start_epoch: int = 0, max_steps_per_epoch: int = 0, finetune_cap: int = 5000) -> DataFrame:
    """Steps and token counts a training run over this dataset would use."""
    L, B = int(seq_len), int(batch_size)
    train = F.col("train_split_index")
    full = F.expr(f"train_split_index div {B * L}")
    steps = F.least(F.lit(max_steps_per_epoch).cast("bigint"), full) if max_steps_per_epoch > 0 else full
    remaining = epochs - start_epoch
    seqs = F.expr(f"(total_tokens - 1) div {L}")
    return manifest.select(
        "total_tokens", "train_split_index",
        full.alias("full_steps_per_epoch"),
        steps.alias("steps_per_epoch"),
        F.lit(B * L).cast("bigint").alias("tokens_per_step"),
        F.lit(remaining).alias("remaining_epochs"),
        (steps * F.lit(remaining * B * L)).alias("tokens_seen"),
        F.when(train > 0, steps * F.lit(remaining * B * L) / train).alias("times_dataset"),
        seqs.alias("num_sequences"),
        F.least(F.expr(f"((total_tokens - 1) div {L}) div {B}"), F.lit(finetune_cap).cast("bigint"))
        .alias("finetune_steps_per_epoch"))


# ---- F6: sequential blocks ---------------------------------------------------------------

def sequential_blocks(blocks: DataFrame, total_tokens: int, seq_len: int) -> DataFrame:
    """The ``(total-1) // L`` complete non-overlapping sequences: x = block k, y = the
    same block shifted by one token.  ``blocks`` overlap by one token or more."""
    L = int(seq_len)
    full = (int(total_tokens) - 1) // L
    return (blocks.where(F.col("block") < full)
            .select(F.col("block").alias("seq"), F.slice("ids", 1, L).alias("x"), F.slice("ids", 2, L).alias("y")))


# ---- F7 / F8 -----------------------------------------------------------------------------------

def stream_head(tokens_off: DataFrame, n: int, ids: str = "ids") -> DataFrame:
    """One row with the first ``n`` ids of the stream."""
    head = (tokens_off.where(F.col("start_pos") < n)
            .select("start_pos", F.slice(ids, 1, F.lit(n) - F.col("start_pos").cast("int")).alias("_h")))
    return head.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start_pos", "_h"))),
                                          lambda s: s["_h"])).alias("head"))


def context_tail(ids, n: int) -> Column:
    """Last ``n`` ids (all of them when shorter)."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.slice(c, F.greatest(F.lit(1), F.size(c) - F.lit(n) + 1), n)


# ---- F9: sampling rows -----------------------------------------------------------------------------

def sample_without_replacement(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """``k`` distinct rows: the ``k`` smallest hashed keys (ties by key).

    The k-th smallest 32-bit hash is found exactly in two passes over counts (its upper,
    then its lower 16 bits), and rows are kept by comparison with it, where they are.
    Only rows whose hash equals it are ordered: one in 2^32 of all, by expectation."""
    if int(k) <= 0:
        return df.limit(0)
    h = df.withColumn("_h", md5_bits(F.lit(seed), key))
    left, low, bound = int(k), 0, 1 << 32
    for width in (1 << 16, 1):
        part = h.where((F.col("_h") >= low) & (F.col("_h") < bound)).groupBy(F.expr(f"_h div {width}").alias("p")).count()
        found = None
        for r in sorted(part.collect(), key=lambda r: r["p"]):  # 65,536 counts at most
            if r["count"] >= left:
                found = r["p"]
                break
            left -= r["count"]
        if found is None:
            return df  # no more rows than asked for
        low, bound = found * width, (found + 1) * width
    edge = h.where(F.col("_h") == low).orderBy(key).limit(left)
    return h.where(F.col("_h") < low).unionByName(edge).drop("_h")


def sample_with_replacement(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """``k`` draws of a uniformly chosen row each; ``draw`` numbers them."""
    n = df.count()
    if n == 0:
        raise ValueError("cannot sample from an empty table")
    idx = dense_index(df, key, "_row")
    draws = df.sparkSession.range(int(k)).select(
        F.col("id").alias("draw"),
        F.floor(md5_unit(F.lit(seed), F.col("id")) * F.lit(n)).cast("bigint").alias("_row"))
    return idx.join(draws, "_row").drop("_row")
