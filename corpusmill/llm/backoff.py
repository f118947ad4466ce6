"""Language-model scores by stupid backoff, computed from the corpus's own counts.

The model has words and pairs.  A word after a context (the word before it, or the
start of the text) has the score count(context, word) / count(context) if the pair
occurs at least ``least_pair`` times, else ``BACKOFF`` times count(word) / all words.
A document's score is the mean of the logarithms over its words.

The counts are tables partitioned by hash, and documents come to them as exploded
n-grams: pairs meet their counts in the partition of their context, pairs that back
off meet the word's count in the partition of the word, and partial sums are added
for each document: first within the task, then in parts that documents are dealt into by
key.  Rows carry a bucket's n-grams, or a part's sums, of many documents packed together,
about 8 bytes for each pair and 32 for each sum.

Scale: both tables and all n-grams are dealt out by hash into buckets, several to a shuffle
partition.  Spark sorts a partition by bucket and a task holds one bucket at a time.
Pairs meet their counts in ``_ROUNDS`` rounds, each a scan of the texts for the pairs of
its own buckets, so that the largest exchange is on disk a part at a time.
Words that make up more than ``1 / HOT_PARTS`` of the corpus (at most ``HOT_PARTS``
of them, so their counts are broadcast) are no partition keys: their pairs are dealt
out by pair, and backing off to them needs no shuffle.  Pairs that make up as much (so
fewer than ``HOT_PARTS``, both words hot) would still meet in one bucket: their counts,
summed map-side over a scan of their own, are broadcast and their occurrences scored
where they are scanned.  Word counts are summed map-side.  Nothing else is broadcast or
collected.

Words are named by 48 bits of a hash: in a vocabulary of 10^9 words, one word in
3 * 10^5 shares its name with another.

Defined results: an empty table gives an empty one.  Words are cut at ASCII white space and A-Z lower-cased.  A text
without words, or null, has ``n_words`` 0 and a null score.  Rows of equal id and
text count as documents of the corpus each, and get equal scores; null ids are ids.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import textarrays as ta
from corpusmill.llm.common import lean, stored

BACKOFF = 0.4
#: Occurrences from which the registered query scores a pair as one: its model is the scored corpus, so from 1 on no word would back off.
LEAST_PAIR = 2
#: A word or pair is hot if it is more than one in so many; so there are fewer hot ones than this.
HOT_PARTS = 2000
#: Pairs that a task packs at once, and words whose counts it adds up at once.
_PACK = 300_000
#: Partial sums of documents that a task adds up at once.
_SUMS = 1_000_000
#: Buckets of a shuffle partition; a task holds one of them at a time.
_SPLIT = 2
#: Rounds in which pairs meet their counts, each over its share of the buckets: only one round's shuffle is on disk at once.
_ROUNDS = 2
_WORD = np.uint64((1 << 48) - 1)
#: The name of the start of a text.
START = np.uint64(0)


def _names(c: ta.Chunk) -> np.ndarray:
    return np.maximum(c.word_hashes() & _WORD, np.uint64(1))


def _pairs(c: ta.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(context, word, row)`` of every word of a chunk."""
    word = _names(c)
    context = np.concatenate(([START], word[:-1])).astype(np.uint64)[:len(word)]
    first = c.word_at[:-1][c.n_words > 0]
    context[first] = START
    return context, word, c.row_of_word()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n, follows)``: occurrences of each word, and those as a context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counts() -> pa.RecordBatch:
            both = np.concatenate(held)
            name, at = np.unique(both & _WORD, return_inverse=True)
            context = (both >> np.uint64(48)).astype(bool)
            n, follows = np.bincount(at, weights=~context, minlength=len(name)), np.bincount(at, weights=context, minlength=len(name))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(name.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(follows.astype(np.int64))],
                                              names=["word", "n", "follows"])

        for b in batches:
            for c in ta.chunks(b.column("text"), ta.NON_SPACE, True):
                context, word, _ = _pairs(c)
                held += [word, context | np.uint64(1 << 48)]
                if sum(map(len, held)) > _PACK:
                    yield counts()
        if held:
            yield counts()

    found = docs.select(F.col(text).alias("text")).mapInArrow(lean(run), "word long, n long, follows long")
    return stored(found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("follows").alias("follows")), "word-counts")


def hot_pairs(docs: DataFrame, at_hot: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], many: float) -> DataFrame:
    """``(pair, n)`` of the pairs of hot words that occur more than ``many`` times; ``pair`` has the places of both words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counts() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for b in batches:
            for c in ta.chunks(b.column("text"), ta.NON_SPACE, True):
                context, word, _ = _pairs(c)
                pair, both = _pair_places(context, word, at_hot)
                held.append(pair[both])
                if sum(map(len, held)) > _PACK:
                    yield counts()
        if held:
            yield counts()

    found = docs.select("text").mapInArrow(lean(run), "pair long, n long")
    return found.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") > many)


def _pair_places(context: np.ndarray, word: np.ndarray, at_hot: Callable) -> tuple[np.ndarray, np.ndarray]:
    """The places of both words among the hot ones as one number, and whether both are hot."""
    (hot_c, at_c), (hot_w, at_w) = at_hot(context), at_hot(word)
    return at_c.astype(np.int64) << 32 | at_w, hot_c & hot_w


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(raw) -> np.ndarray:
    six = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), dtype=np.uint8)
    out[:, :6] = six
    return out.view("<u8").reshape(-1)


def _packed(bucket: np.ndarray, group: np.ndarray, word: np.ndarray | None, doc: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
    """``(bucket, names, lengths, words, places, keys)`` for each bucket: its entries sorted by ``group``,
    whose names are held once, and the keys of the documents that they are places of."""
    order = np.argsort(bucket.astype(np.uint64) << np.uint64(48) | group, kind="stable")
    bucket, group, doc = bucket[order], group[order], doc[order]
    word = None if word is None else word[order]
    cut = np.concatenate((np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), [len(bucket)]))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        first = np.flatnonzero(np.concatenate(([True], group[a + 1:b] != group[a:b - 1])))
        docs, place = np.unique(doc[a:b], return_inverse=True)
        yield (int(bucket[a]), _six(group[a:b][first]), np.diff(np.concatenate((first, [b - a]))).astype("<u4").tobytes(),
               b"" if word is None else _six(word[a:b]), place.astype("<u2" if len(docs) <= 1 << 16 else "<u4").tobytes(), keys[docs].tobytes())


_PACKED = "bucket int, names binary, lengths binary, words binary, places binary, keys binary"
_PACKED_ARROW = [pa.int32()] + [pa.binary()] * 5


def _packed_batch(rows: list[tuple], more: dict | None = None) -> pa.RecordBatch:
    names = ["bucket", "names", "lengths", "words", "places", "keys"]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _PACKED_ARROW, strict=True)] if rows else [pa.array([], k) for k in _PACKED_ARROW]
    return pa.RecordBatch.from_arrays([*arrays, *(more or {}).values()], names=[*names, *(more or {})])


def _unpacked(columns: dict[str, list]) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    """``(group, word, document, keys)`` of the entries of packed rows."""
    group, word, doc, keys, at = [], [], [], [], 0
    for names, lengths, words, places, own in zip(*(columns[k] for k in ("names", "lengths", "words", "places", "keys")), strict=True):
        length, key = np.frombuffer(lengths, dtype="<u4"), np.frombuffer(own, dtype=np.int64)
        group.append(np.repeat(_from_six(names), length))
        if words:
            word.append(_from_six(words))
        wide = len(places) // max(1, len(group[-1]))
        doc.append(np.frombuffer(places, dtype="<u2" if wide == 2 else "<u4").astype(np.int64) + at)
        keys.append(key)
        at += len(key)
    key, same = np.unique(np.concatenate(keys), return_inverse=True)
    return np.concatenate(group), np.concatenate(word) if word else None, same[np.concatenate(doc)], key


def _by_bucket(batches: Iterator[pa.RecordBatch], wanted: list[str]) -> Iterator[tuple[int, dict[str, list]]]:
    """The rows of a partition that is sorted by bucket, one bucket after another."""
    now, held = None, {k: [] for k in wanted}
    for b in batches:
        columns = {k: b.column(k).to_pylist() for k in wanted}
        for r, bucket in enumerate(b.column("bucket").to_pylist()):
            if bucket != now:
                if held[wanted[0]]:
                    yield now, held
                now, held = bucket, {k: [] for k in wanted}
            for k in wanted:
                held[k].append(columns[k][r])
    if held[wanted[0]]:
        yield now, held


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_pair: int = 1, backoff: float = BACKOFF) -> DataFrame:
    """``(doc_id, n_words, n_pairs, score)``: words, those scored as pairs, and the mean log score, of each document."""
    spark = docs.sparkSession
    # equal rows share a key: their sums double, and the mean stays
    key = F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit("")))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), F.col(text).alias("text"))
    counts = word_counts(keyed)
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = max(total / HOT_PARTS, 1)
    rows = counts.where(F.greatest("n", "follows") > many).orderBy("word").collect()  # at most 2 * HOT_PARTS rows
    hot = spark.sparkContext.broadcast(tuple(np.array([r[k] for r in rows], dtype=t) for k, t in enumerate((np.uint64, np.int64, np.int64))))
    buckets = min(_SPLIT * int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << 16) - 1)

    def is_hot(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = hot.value[0]
        if not len(known):
            return np.zeros(len(names), dtype=bool), np.zeros(len(names), dtype=np.int64)
        at = np.minimum(np.searchsorted(known, names), len(known) - 1)
        return known[at] == names, at

    rows = hot_pairs(keyed, is_hot, many).orderBy("pair").collect()  # fewer than HOT_PARTS rows
    often = spark.sparkContext.broadcast(tuple(np.array([r[k] for r in rows], dtype=np.int64) for k in ("pair", "n")))

    def scored(context: np.ndarray, word: np.ndarray, doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, list[pa.RecordBatch]]:
        """Which pairs are hot, and the sums of their scores."""
        known, n = often.value
        if not len(known):
            return np.zeros(len(word), dtype=bool), []
        pair, both = _pair_places(context, word, is_hot)
        at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
        both &= known[at] == pair
        if not both.any():
            return both, []
        pair, n_pair, doc = pair[both], n[at[both]], doc[both]
        good = n_pair >= least_pair
        logs = np.where(good, np.log(n_pair / hot.value[2][pair >> 32]), np.log(backoff * np.maximum(hot.value[1][pair & 0xFFFFFFFF], 1) / total))
        sums, terms = np.bincount(doc, weights=logs, minlength=len(keys)), np.bincount(doc, minlength=len(keys))
        return both, [_sums_batch(keys, sums, terms, np.bincount(doc[good], minlength=len(keys)), int(keys[0]) % buckets)]

    def explode(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, same = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True)
            at = np.concatenate(([0], np.cumsum([len(h[3]) for h in held])))
            context, word, bucket = (np.concatenate([h[k] for h in held]) for k in (0, 1, 4))
            doc = same[np.concatenate([h[2] + a for h, a in zip(held, at, strict=False)])]
            held.clear()
            ready, sums = scored(context, word, doc, keys)
            yield from sums
            if ready.all():
                return
            rows = list(_packed(bucket[~ready], context[~ready], word[~ready], doc[~ready], keys))
            none = pa.nulls(len(rows), pa.binary())
            yield _packed_batch(rows, {"sums": none, "terms": none, "whole": none})

        for b in batches:
            keys = b.column("key").to_numpy()
            for c in ta.chunks(b.column("text"), ta.NON_SPACE, True):
                context, word, row = _pairs(c)
                common, _ = is_hot(context)
                deal = np.where(common, ta.mix(context ^ ta.mix(word)), ta.mix(context))
                bucket = ((deal >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16)
                own = bucket % _ROUNDS == turn
                if own.any():
                    held.append((context[own], word[own], row[own], keys[c.row0:c.row0 + c.rows], bucket[own]))
                    size += len(held[-1][0])
                if size >= _PACK:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in _by_bucket(batches, ["names", "lengths", "words", "places", "keys", "sums", "terms", "whole"]):
            ready = [r for r, v in enumerate(columns["sums"]) if v is not None]  # sums of hot pairs pass as they are
            for r in ready:
                yield _packed_batch([(0, None, None, None, None, columns["keys"][r])],
                                    {k: pa.array([columns[k][r]], pa.binary()) for k in ("sums", "terms", "whole")})
            entries = [r for r, v in enumerate(columns["sums"]) if v is None]
            if not entries:
                continue
            columns = {k: [columns[k][r] for r in entries] for k in ("names", "lengths", "words", "places", "keys")}
            context, word, doc, keys = _unpacked(columns)
            columns.clear()
            order = np.lexsort((word, context))
            context, word, doc = context[order], word[order], doc[order]
            new_c = np.concatenate(([True], context[1:] != context[:-1]))
            new_p = new_c | np.concatenate(([True], word[1:] != word[:-1]))
            size = lambda new: np.repeat(*(lambda n: (n, n))(np.diff(np.concatenate((np.flatnonzero(new), [len(new)])))))
            n_pair, n_context = size(new_p), size(new_c)
            common, at = is_hot(context)
            n_context = np.where(common, hot.value[2][at] if len(hot.value[2]) else 0, n_context)
            good = n_pair >= least_pair
            logs = np.where(good, np.log(n_pair / n_context), 0.0)
            low_hot, at = is_hot(word)
            direct = ~good & low_hot
            if direct.any():
                logs[direct] = np.log(backoff * hot.value[1][at[direct]] / total)
            done = good | direct
            sums, terms = np.bincount(doc, weights=logs, minlength=len(keys)), np.bincount(doc[done], minlength=len(keys))
            whole = np.bincount(doc[good], minlength=len(keys))
            yield _sums_batch(keys, sums, terms, whole)
            rest = np.flatnonzero(~done)
            if len(rest):
                deal = ta.mix(word[rest])
                bucket = ((deal >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                rows = list(_packed(bucket, word[rest], None, doc[rest], keys))
                none = pa.nulls(len(rows), pa.binary())
                yield _packed_batch(rows, {"sums": none, "terms": none, "whole": none})

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in _by_bucket(batches, ["names", "lengths", "words", "places", "keys", "word", "n"]):
            table = [(w, n) for w, n in zip(columns["word"], columns["n"], strict=True) if w is not None]
            entries = [r for r, w in enumerate(columns["word"]) if w is None]
            if not entries:
                continue
            word, _, doc, keys = _unpacked({k: [columns[k][r] for r in entries] for k in ("names", "lengths", "words", "places", "keys")})
            columns.clear()
            known = np.array(sorted(table), dtype=np.int64).reshape(-1, 2)
            n = known[np.searchsorted(known[:, 0], word.astype(np.int64)), 1]
            sums = np.bincount(doc, weights=np.log(backoff * n / total), minlength=len(keys))
            terms = np.bincount(doc, minlength=len(keys))
            yield _sums_batch(keys, sums, terms, np.zeros(len(keys)))

    extra = ", sums binary, terms binary, whole binary"

    def met_pairs(turn: int) -> DataFrame:
        exploded = keyed.select("key", "text").mapInArrow(lean(partial(explode, turn=turn)), _PACKED + extra)
        return stored(exploded.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lean(pairs), _PACKED + extra), "pair-scores")

    first = reduce(DataFrame.unionByName, [met_pairs(turn) for turn in range(_ROUNDS)])

    def to_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name = b.column("word").to_numpy().astype(np.uint64)
            bucket = ((ta.mix(name) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            cold = ~is_hot(name)[0] & (b.column("n").to_numpy() > 0)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cold]), b.column("word").filter(pa.array(cold)), b.column("n").filter(pa.array(cold))],
                                             names=["bucket", "word", "n"])

    table = counts.select("word", "n").mapInArrow(to_bucket, "bucket int, word long, n long")
    back = first.where("sums IS NULL").drop("sums", "terms", "whole")
    met = back.unionByName(table, allowMissingColumns=True).repartition("bucket").sortWithinPartitions("bucket")
    second = met.mapInArrow(lean(words), _PACKED + extra)
    sums = first.where("sums IS NOT NULL").unionByName(second).select("keys", "sums", "terms", "whole")
    dealt = sums.mapInArrow(lean(_dealt(buckets)), "part int, keys binary, sums binary, terms binary, whole binary")
    summed = dealt.repartition("part").sortWithinPartitions("part").mapInArrow(lean(_added), "key long, s double, terms long, whole long")
    # equal rows share a key; each has the sums of all of them
    rows = keyed.select("doc_id", "key", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_words"))
    return rows.join(summed, "key", "left").select(
        "doc_id", "n_words", F.coalesce((F.col("whole") * F.col("n_words") / F.col("terms")).cast("long"), F.lit(0).cast("long")).alias("n_pairs"),
        F.round(F.col("s") / F.col("terms"), 6).alias("score"))


def _sums_batch(keys: np.ndarray, sums: np.ndarray, terms: np.ndarray, whole: np.ndarray, bucket: int = 0) -> pa.RecordBatch:
    used = terms > 0
    packed = [keys[used].astype("<i8"), sums[used].astype("<f8"), terms[used].astype("<u4"), whole[used].astype("<u4")]
    names = ["bucket", "names", "lengths", "words", "places", "keys", "sums", "terms", "whole"]
    arrays = [pa.array([bucket], pa.int32()), *(pa.nulls(1, pa.binary()) for _ in range(4)), *(pa.array([p.tobytes()], pa.binary()) for p in packed)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


_Sums = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _together(held: list[_Sums]) -> _Sums:
    """One entry for each document of ``held``, sorted by key."""
    key, same = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    s, terms, whole = (np.bincount(same, weights=np.concatenate([h[k] for h in held]), minlength=len(key)) for k in (1, 2, 3))
    return key, s, terms.astype(np.int64), whole.astype(np.int64)


def _sums_of(b: pa.RecordBatch, r: int, count: str) -> _Sums:
    return tuple(np.frombuffer(b.column(k)[r].as_buffer(), dtype=t)
                 for k, t in (("keys", "<i8"), ("sums", "<f8"), ("terms", count), ("whole", count)))


def _dealt(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packed sums, added up within the task, one row for each part that documents are dealt into by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Sums] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = _together(held)
            held.clear()
            part = ((ta.mix(columns[0].view(np.uint64)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part = part[order]
            cut = [*np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))).tolist(), len(part)]
            packed = [pa.array([c[order[i:j]].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for c in columns]
            return pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]], pa.int32()), *packed], names=["part", "keys", "sums", "terms", "whole"])

        for b in batches:
            for r in range(b.num_rows):
                held.append(_sums_of(b, r, "<u4"))
                size += len(held[-1][0])
                if size >= _SUMS:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's sums, of a partition sorted by part: what is held is a part's documents and ``_SUMS`` entries."""
    now, held, size = None, [], 0

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in _together(held)], names=["key", "s", "terms", "whole"])

    for b in batches:
        for r, part in enumerate(b.column("part").to_pylist()):
            if part != now and held:
                yield rows()
                held, size = [], 0
            now = part
            held.append(_sums_of(b, r, "<i8"))
            size += len(held[-1][0])
            if size >= _SUMS:
                held, size = [_together(held)], 0
    if held:
        yield rows()
