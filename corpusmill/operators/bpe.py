"""Byte-level BPE as Spark jobs.

* pre-tokenization (E1) and word counting (E2) are JVM expressions plus one
  map-side-combined aggregate;
* merge learning (E6) keeps the distinct words as arrays of ids, dealt over the tasks:
  a round counts all pairs, cuts the words at pairs that can't be merged in it, and one
  task merges the few distinct segments left, some hundred merges a round;
  the driver has the merge list and the counts of the first pairs;
* encoding (E7) is narrow: documents are pre-tokenized in the JVM and an Arrow
  UDF applies the (vocabulary-bounded, broadcast) merge table word by word
  with a per-batch cache, so frequent words are encoded once per batch and
  nothing is shuffled;
* decoding (E8) is a JVM expression over a literal id -> bytes array.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import functools
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.session import scratch_path

# --- fixed values: special tokens (ids 0, 1, 2 in this order) and the split pattern ---
SPECIALS = ["<|endoftext|>", "<|pad|>", "<|unk|>"]
UNK = "<|unk|>"
# Contractions, letters, digits, other symbols, then whitespace (Java syntax, Unicode classes).
PRETOKEN_PATTERN = "(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"
# ---------------------------------------------------------------------------------------------


@functools.lru_cache(maxsize=None)
def byte_standins() -> tuple[str, ...]:
    """Printable stand-in character for each byte value (the byte-level rule):
    printable Latin-1 bytes stand for themselves, the other 68 byte values are
    shifted above U+00FF in byte order."""
    own = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    out, shift = [], 0
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(0x100 + shift))
            shift += 1
    return tuple(out)


def pretokenize(c) -> Column:
    """Pre-tokens of a text (E1); lossless: they concatenate back to the text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(col, F.lit(PRETOKEN_PATTERN), 0)


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)`` pre-token frequencies."""
    return (df.select(F.explode(pretokenize(text_col)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def byte_values(word) -> Column:
    """UTF-8 bytes of a string as ``ARRAY<INT>``."""
    return F.transform(F.filter(F.split(byte_symbols(word), " "), lambda x: x != ""),
                       lambda x: F.conv(x, 16, 10).cast("int"))


def byte_symbols(word) -> Column:
    """Bytes as two-hex-digit symbols separated by spaces."""
    h = F.hex(F.encode(F.col(word) if isinstance(word, str) else word, "UTF-8"))
    return F.trim(F.regexp_replace(h, "(..)", "$1 "))


# ---- the model ----------------------------------------------------------------------------------

@dataclass
class BpeModel:
    """Vocabulary (id -> bytes, specials first) and merges in rank order."""

    tokens: list = field(default_factory=list)       # bytes for learned symbols, str for specials
    merges: list = field(default_factory=list)       # (left_id, right_id, new_id)
    n_specials: int = len(SPECIALS)

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    def token_text(self, i: int) -> str:
        t = self.tokens[i]
        return t if isinstance(t, str) else "".join(byte_standins()[b] for b in t)

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t.encode("utf-8").hex().upper() if isinstance(t, str) else t.hex().upper(),
                 isinstance(t, str), self.token_text(i)) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "id int, token_hex string, is_special boolean, token string")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, n) for r, (a, b, n) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left_id int, right_id int, new_id int")

    def byte_ids(self) -> list:
        """id of the single-byte symbol for each byte value, or None."""
        out = [None] * 256
        for i, t in enumerate(self.tokens):
            if isinstance(t, bytes) and len(t) == 1:
                out[t[0]] = i
        return out


def byte_alphabet(words: DataFrame) -> DataFrame:
    """Bytes seen in the words, with ids after the specials in the order of
    their stand-in characters (E4).  At most 256 rows."""
    seen = words.select(F.explode(byte_values("word")).alias("byte")).distinct()
    standin = F.element_at(F.array(*[F.lit(s) for s in byte_standins()]), F.col("byte") + 1)
    from pyspark.sql import Window

    return (seen.withColumn("token", standin)
            .withColumn("id", (F.row_number().over(Window.orderBy("token")) + len(SPECIALS) - 1).cast("int")))


def _symbol_strings(words: DataFrame, byte_to_id: list) -> DataFrame:
    """``(sym, n)``: each word as `` id id id `` (leading and trailing space)."""
    table = F.expr("cast(array(" + ",".join("NULL" if v is None else str(v) for v in byte_to_id) + ") as array<int>)")
    b = words.select(byte_values("word").alias("_b"), "n")
    ids = F.transform("_b", lambda x: F.element_at(table, x + 1).cast("string"))
    return b.select(F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" ")).alias("sym"), "n")


def _counted_pairs(syms: DataFrame) -> DataFrame:
    """``(left, right, cnt, held)``: occurrences in the corpus, and in the distinct words."""
    arr = F.split(F.trim("sym"), " ")
    k = F.size(arr) - 1
    z = F.arrays_zip(F.slice(arr, 1, k).alias("l"), F.slice(arr, 2, k).alias("r"))
    return (syms.where(F.size(arr) > 1)
            .select(F.explode(z).alias("p"), "n")
            .groupBy(F.col("p.l").cast("int").alias("left"), F.col("p.r").cast("int").alias("right"))
            .agg(F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("held")))


def pair_counts(syms: DataFrame) -> DataFrame:
    """``(left, right, cnt)`` weighted counts of adjacent symbol pairs (E5)."""
    return _counted_pairs(syms).select("left", "right", "cnt")


#: Pairs from which a round's merges are taken where segments are too many for one task.
TOP_CANDIDATES = 512
#: Pairs of a round: in the first one, at least and at most.  The driver keeps their counts.
LOCAL_PAIRS = 8
KEPT_PAIRS = 50_000
#: Distinct segments that one task merges on its own, and symbols of one on the average at most.
LOCAL_WORDS = 100_000
INDEXED = 64
#: The words are written anew once merges have taken this share of their pairs, or after so many rounds.
SPARSE = 1 / 24
COMPACT = 24
#: Symbols that a task counts at once.
_COUNTED = 2_000_000
#: Words whose ids an encoding task keeps, and their length at most.
CACHED_WORDS = 200_000
CACHED_LENGTH = 64


def _batch_merges(model: BpeModel, index: dict, batch: list) -> list:
    """Adds the symbols of a round's merges to the model; returns the merges."""
    merges = []
    for _, a, b in batch:
        token = model.tokens[a] + model.tokens[b]
        fresh = token not in index
        if fresh:
            index[token] = len(model.tokens)
            model.tokens.append(token)
        merges.append((a, b, index[token]))
        model.merges.append(merges[-1])
        if not fresh:
            break  # an old symbol gains occurrences: later candidates are not certain
    return merges


def _exact_batch(best: list, floor: int, min_frequency: int, room: int) -> list:
    """The longest prefix of ``best`` that sequential merging would also pick.

    Merging (a, b) into m only removes occurrences of pairs touching a or b;
    any such pair ranked above the next candidate stops the batch, because
    candidates must not touch a merged symbol.  New pairs (x, m) and (m, y)
    occur at most as often as (x, a) and (b, y) did, so the next candidate is
    exact when its count beats every pair with a on the right or b on the left
    (pairs outside the candidate list count at most ``floor``).  A pair (a, a)
    ends the batch (its own leftovers are not bounded that way).
    """
    accepted, used, bound = [], set(), -1
    for cnt, a, b in best:
        if len(accepted) >= room or cnt < min_frequency:
            break
        if accepted and (a in used or b in used or cnt <= bound):
            break
        accepted.append((cnt, a, b))
        used.update((a, b))
        taken = {(x, y) for _, x, y in accepted}
        touching = [c for c, x, y in best if (y == a or x == b) and (x, y) not in taken]
        bound = max([bound, floor] + touching[:1])
        if a == b:
            break
    return accepted


_WORDS = "ids array<int>, n long"


def _id_words(byte_to_id: list):
    """Words ``(word, n)`` as ids of their bytes, those of two and more."""
    ids_of = np.array([-1 if v is None else v for v in byte_to_id], dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = pa.RecordBatch.from_arrays([b.column("word").cast(pa.large_binary()), b.column("n")], names=["word", "n"])
            b = b.filter(pc.greater(pc.binary_length(b.column("word")), 1))
            start = np.concatenate(([0], np.cumsum(pc.binary_length(b.column("word")).to_numpy(zero_copy_only=False)))).astype(np.int32)
            raw = np.frombuffer(b"".join(b.column("word").to_pylist()), dtype=np.uint8)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(start), pa.array(ids_of[raw])), b.column("n")], names=["ids", "n"])

    return run


def _laid_out(b: pa.RecordBatch) -> np.ndarray:
    """The ids of a batch of words one after another, with a -1 after each word."""
    col = b.column("ids")
    ids, size = col.flatten().to_numpy(zero_copy_only=False), np.diff(col.offsets.to_numpy())
    out = np.full(len(ids) + len(size), -1, dtype=np.int32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size)] = ids
    return out


def _merge_all(v: np.ndarray, merges: list) -> np.ndarray:
    """Merge after merge over laid out words; from left to right where occurrences overlap."""
    for a, b, m in merges:
        at = np.flatnonzero((v[:-1] == a) & (v[1:] == b))
        if not len(at):
            continue
        if a == b:
            first = np.concatenate(([True], at[1:] != at[:-1] + 1))
            run = np.flatnonzero(first)[np.cumsum(first) - 1]
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        v[at] = m
        stays = np.ones(len(v), dtype=bool)
        stays[at + 1] = False
        v = v[stays]
    return v


def _pairs_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pair that starts at each place but the last, as one number, and whether both of it are in one word."""
    return v[:-1].astype(np.int64) << 32 | v[1:], (v[:-1] >= 0) & (v[1:] >= 0)


def _merged_words(merges: list):
    """Words after the merges, those of two symbols and more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _merge_all(_laid_out(b), merges)
            ends = np.flatnonzero(v < 0)
            size = np.diff(np.concatenate(([-1], ends))) - 1
            live = size > 1
            ids = v[np.repeat(live, size + 1) & (v >= 0)]
            start = np.concatenate(([0], np.cumsum(size[live]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(start), pa.array(ids)), b.column("n").filter(pa.array(live))], names=["ids", "n"])

    return run


def _pair_sums(merges: list):
    """``(pair, cnt, held)`` of the words after the merges: occurrences in the corpus and in the distinct words, of a part of the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def sums() -> pa.RecordBatch:
            pair, n, times = (np.concatenate([h[k] for h in held]) for k in range(3))
            held.clear()
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            held.append((pair[new], np.add.reduceat(n[order], new), np.add.reduceat(times[order], new)))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names=["pair", "cnt", "held"])

        for b in batches:
            v = _merge_all(_laid_out(b), merges)
            pair, whole = _pairs_of(v)
            word = (np.cumsum(v < 0) - (v < 0))[:-1][whole]
            if len(word):
                held.append((pair[whole], b.column("n").to_numpy()[word], np.ones(len(word), dtype=np.int64)))
            if sum(len(h[0]) for h in held) > _COUNTED:
                done = sums()
                if done.num_rows > _COUNTED // 2:  # many different pairs: passed on, not held
                    held.clear()
                    yield done
        if held:
            yield sums()

    return run


def _segments(merges: list, kept: list):
    """``(ids, n)``: runs of the words after the merges in which all pairs are among ``kept``, as bytes, of a part of the words."""
    known = np.sort(np.array(kept, dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict = {}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], names=["ids", "n"])
            count.clear()
            return out

        for b in batches:
            v = _merge_all(_laid_out(b), merges)
            pair, whole = _pairs_of(v)
            whole &= known[np.minimum(np.searchsorted(known, pair), len(known) - 1)] == pair
            edge = np.diff(np.concatenate(([0], whole.astype(np.int8), [0])))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            n = b.column("n").to_numpy()[(np.cumsum(v < 0) - (v < 0))[first]]
            raw = v.tobytes()
            for i, j, k in zip((first * 4).tolist(), (last * 4 + 4).tolist(), n.tolist()):
                seg = raw[i:j]
                count[seg] = count.get(seg, 0) + k
            if len(count) > 2 * LOCAL_WORDS:
                yield rows()
        if count:
            yield rows()

    return run


def _pairs(ids: list) -> dict:
    out: dict = {}
    for a, b in zip(ids, ids[1:]):
        p = a << 32 | b
        out[p] = out.get(p, 0) + 1
    return out


def _merge_pair(ids: list, a: int, b: int, new: int) -> list:
    out, i, last = [], 0, len(ids) - 1
    while i <= last:
        if i < last and ids[i] == a and ids[i + 1] == b:
            out.append(new)
            i += 2
        else:
            out.append(ids[i])
            i += 1
    return out


def _learned(best: list, after: tuple, tokens: list, room: int, least: int):
    """A round in which one task takes merge after merge over all segments of the pairs of ``best``.

    ``best`` has the first pairs in merge order with their counts, ``after`` is the order
    of the next.  A symbol made in the round has one pair of symbols at its start and end,
    so a pair with it occurs only where one pair occurred when the round began, at most as
    often, and comes no earlier in merge order.  Where that pair is not in ``best`` the
    words are cut, and what could be merged there comes after ``after``; where it is, all
    occurrences are in the segments.  So the task's choice is right until it comes after
    ``after``, or makes a symbol that is there already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, weight = [], []
        for b in batches:
            now += [np.frombuffer(x, dtype=np.int32).tolist() for x in b.column("ids").to_pylist()]
            weight += b.column("n").to_pylist()
        count = {a << 32 | b: c for c, a, b in best}
        known, index = list(tokens), {t: i for i, t in enumerate(tokens)}
        where: dict = {}
        for k, ids in enumerate(now):
            for p in _pairs(ids):
                where.setdefault(p, set()).add(k)
        heap = [(-c, p) for p, c in count.items()]
        heapify(heap)
        merges: list = []
        while heap and len(known) - len(tokens) < room:
            minus, p = heappop(heap)
            if -minus != count[p]:  # it has lost occurrences since
                if count[p] > 0:
                    heappush(heap, (-count[p], p))
                continue
            a, b = p >> 32, p & 0xFFFFFFFF
            if -minus < least or (minus, a, b) >= after:
                break
            token = known[a] + known[b]
            fresh = token not in index
            if fresh:
                index[token] = len(known)
                known.append(token)
            merges.append((a, b, index[token]))
            if not fresh:
                break  # an old symbol gains occurrences: pairs outside may gain too
            touched = set()
            for k in where.pop(p, ()):
                old, new = now[k], _merge_pair(now[k], *merges[-1])
                if len(old) == len(new):
                    continue
                now[k] = new
                before, later, n = _pairs(old), _pairs(new), weight[k]
                for q in before.keys() | later.keys():
                    if gain := later.get(q, 0) - before.get(q, 0):
                        count[q] = count.get(q, 0) + n * gain
                        if gain > 0:
                            touched.add(q)
                            where.setdefault(q, set()).add(k)
            for q in touched:
                heappush(heap, (-count[q], q))
        if merges:
            rank = pa.array(range(len(merges)), pa.int32())
            yield pa.RecordBatch.from_arrays([rank, *(pa.array(c, pa.int32()) for c in zip(*merges))], names=["rank", "l", "r", "m"])

    return run


def learn_bpe(df: DataFrame, text_col: str = "text", vocab_size: int = 32000, min_frequency: int = 2,
              candidates: int = TOP_CANDIDATES, local_words: int = LOCAL_WORDS, indexed: int = INDEXED,
              sparse: float = SPARSE) -> BpeModel:
    """Learn merges (E6): repeatedly merge the most frequent adjacent pair
    (ties: smallest left id, then right id) until the vocabulary reaches
    ``vocab_size`` or the best count drops below ``min_frequency``.

    A round counts all pairs of the distinct words and takes the first ones.  Words are
    cut wherever two symbols are none of these pairs; equal segments are added up, and one
    task merges them one by one until a pair outside could come first (``_learned``).  The
    next round's pairs are twice as many where segments were few, a quarter where they were
    more than ``local_words``; where even the least number of pairs has too many, the round takes
    the longest run of merges that the counts alone make certain (``_exact_batch``).  So a
    round passes over the words two or three times, whatever its number of merges.  Words
    are tables in the session's checkpoint folder, written anew once merges have taken
    ``sparse`` of their pairs; until then each pass makes the merges since.
    """
    spark = df.sparkSession
    root = scratch_path(spark, "bpe")
    word_counts(df, text_col).write.parquet(f"{root}/counts")
    words = spark.read.schema("word string, n long").parquet(f"{root}/counts")
    chars = words.select(F.explode(F.split("word", "")).alias("word")).distinct()
    alpha = byte_alphabet(chars).collect()  # <= 256 rows
    model = BpeModel(tokens=list(SPECIALS))
    byte_to_id = [None] * 256
    for r in sorted(alpha, key=lambda r: r["id"]):
        model.tokens.append(bytes([r["byte"]]))
        byte_to_id[r["byte"]] = r["id"]
    index = {t: i for i, t in enumerate(model.tokens)}
    least = max(1, min_frequency)
    parts = max(1, spark.sparkContext.defaultParallelism * 2)  # a small table of words may be one split
    words.mapInArrow(_id_words(byte_to_id), _WORDS).repartition(parts).write.parquet(f"{root}/words")
    now, since, before, rounds, k, tries = spark.read.schema(_WORDS).parquet(f"{root}/words"), [], 0, 0, LOCAL_PAIRS, 0
    while (room := vocab_size - model.vocab_size) > 0:
        counts = now.mapInArrow(_pair_sums(since), "pair long, cnt long, held long").groupBy("pair").agg(F.sum("cnt").alias("cnt"), F.sum("held").alias("held")).persist()
        most = max(k, candidates)
        rows = counts.orderBy(F.desc("cnt"), "pair").limit(most + 1).collect()
        held = counts.agg(F.sum("held")).first()[0] or 0
        counts.unpersist()
        first = [(r["cnt"], r["pair"] >> 32, r["pair"] & 0xFFFFFFFF) for r in rows]
        if not first or first[0][0] < least:
            break
        if rounds == 0:
            before = held
        elif held < before * (1 - sparse) or len(since) and rounds % COMPACT == 0:
            now.mapInArrow(_merged_words(since), _WORDS).write.parquet(f"{root}/words-{rounds}")
            now, since, before = spark.read.schema(_WORDS).parquet(f"{root}/words-{rounds}"), [], held
        rounds += 1
        merges: list = []
        k = max(k, LOCAL_PAIRS)
        while not merges and local_words and k >= LOCAL_PAIRS:
            best = first[:k]
            after = (-first[k][0], *first[k][1:]) if len(first) > k else (0, 0, 0)
            tries += 1
            (now.mapInArrow(_segments(since, [a << 32 | b for _, a, b in best]), "ids binary, n long")
             .groupBy("ids").agg(F.sum("n").alias("n")).write.parquet(f"{root}/segments-{tries}"))
            segments = spark.read.schema("ids binary, n long").parquet(f"{root}/segments-{tries}")
            n, size = segments.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()
            if n > local_words or size > 4 * indexed * local_words:
                k //= 4
                continue
            found = segments.coalesce(1).mapInArrow(_learned(best, after, model.tokens, room, least), "rank int, l int, r int, m int").collect()
            merges = [(r["l"], r["r"], r["m"]) for r in sorted(found, key=lambda r: r["rank"])]
            if 3 * n < local_words:
                k = min(2 * k, KEPT_PAIRS)
        if merges:
            for a, b, m in merges:
                if m == model.vocab_size:
                    model.tokens.append(model.tokens[a] + model.tokens[b])
                    index[model.tokens[m]] = m
            model.merges += merges
        else:
            floor = first[candidates - 1][0] if len(first) >= candidates else 0
            merges = _batch_merges(model, index, _exact_batch(first[:candidates], floor, least, room))
        since = since + merges
    return model


# ---- encode / decode -------------------------------------------------------------------------------

def _merge_word(ids: list, ranks: dict) -> list:
    """Apply merges to one word: repeatedly merge every occurrence (left to
    right, non-overlapping) of the lowest-ranked adjacent pair present.

    A heap of pairs over linked symbols: a long word costs n log n."""
    ids, n = list(ids), len(ids)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(m[0], i) for i in range(n - 1) if (m := ranks.get((ids[i], ids[i + 1])))]
    heapify(heap)
    while heap:
        rank, touched = heap[0][0], set()
        while heap and heap[0][0] == rank:  # all occurrences of this pair, before any new pair
            i = heappop(heap)[1]
            j = right[i]
            m = ranks.get((ids[i], ids[j])) if ids[i] is not None and j >= 0 else None
            if m is None or m[0] != rank:
                continue  # one of its symbols has gone
            ids[i], ids[j], right[i] = m[3], None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            touched |= {i, left[i]}
        for i in touched:
            if i >= 0 and ids[i] is not None and right[i] >= 0 and (m := ranks.get((ids[i], ids[right[i]]))):
                heappush(heap, (m[0], i))
    return [x for x in ids if x is not None]


def _encoder(model: BpeModel):
    ranks = {(a, b): (r, a, b, n) for r, (a, b, n) in enumerate(model.merges)}
    byte_ids = model.byte_ids()
    unk = SPECIALS.index(UNK)
    special_ids = {s: i for i, s in enumerate(SPECIALS)}

    def encode_words(words, cache: dict) -> list:
        out: list = []
        for w in words:
            ids = cache.get(w)
            if ids is None:
                if w in special_ids:
                    ids = [special_ids[w]]
                else:
                    sym = [byte_ids[b] if byte_ids[b] is not None else unk for b in w.encode("utf-8")]
                    ids = _merge_word(sym, ranks)
                if len(cache) < CACHED_WORDS and len(w) <= CACHED_LENGTH:
                    cache[w] = ids
            out.extend(ids)
        return out

    return encode_words


def special_aware_pretokens(c) -> Column:
    """Pre-tokens with special-token text kept whole: the text is split on the
    specials, each piece is pre-tokenized on its own, specials are re-inserted."""
    col = F.col(c) if isinstance(c, str) else c
    pat = "|".join(s.replace("|", "\\|") for s in SPECIALS)
    pieces = F.split(col, pat)
    found = F.regexp_extract_all(col, F.lit(f"({pat})"), 1)
    z = F.arrays_zip(pieces.alias("p"), F.concat(found, F.array(F.lit(None).cast("string"))).alias("s"))
    return F.flatten(F.transform(z, lambda e: F.concat(
        F.regexp_extract_all(e["p"], F.lit(PRETOKEN_PATTERN), 0),
        F.when(e["s"].isNotNull(), F.array(e["s"])).otherwise(F.array().cast("array<string>")))))


def bpe_encoder(model: BpeModel):
    """A column function from text to token ids.  The merge table (bounded by the
    vocabulary size) travels inside the UDF closure; a task keeps the ids of up to
    ``CACHED_WORDS`` words over all of its batches."""
    enc = _encoder(model)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict = {}
        for tokens in batches:
            yield pd.Series([None if t is None else enc(t, cache) for t in tokens])

    return lambda text: _encode(special_aware_pretokens(text))


def bpe_encode(df: DataFrame, model: BpeModel, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Token ids per row (E7): narrow, no shuffle."""
    return df.withColumn(out_col, bpe_encoder(model)(text_col))


def bpe_decode(model: BpeModel, ids) -> Column:
    """Ids to text (E8): special ids and unknown ids are skipped; a byte
    sequence cut mid-character decodes to U+FFFD."""
    col = F.col(ids) if isinstance(ids, str) else ids
    hexes = [("" if isinstance(t, str) else t.hex().upper()) for t in model.tokens]
    table = F.split(F.lit(",".join(hexes)), ",")  # one literal, whatever the vocabulary; split once, by the optimizer
    n = len(hexes)
    parts = F.transform(col, lambda i: F.when((i >= 0) & (i < n), F.try_element_at(table, (i + 1).cast("int"))))
    return F.make_valid_utf8(F.unhex(F.array_join(parts, "")).cast("string"))


def compression_ratio(df: DataFrame, text_col: str, ids_col: str) -> DataFrame:
    """Source bytes per token, null when there are no tokens."""
    return df.agg(F.sum(F.octet_length(text_col)).alias("source_bytes"),
                  F.sum(F.size(ids_col)).alias("tokens")).select(
        "source_bytes", "tokens",
        (F.col("source_bytes") / F.when(F.col("tokens") > 0, F.col("tokens"))).alias("bytes_per_token"))
