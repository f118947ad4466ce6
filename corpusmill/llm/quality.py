"""Quality rules: plain text statistics and a hashed n-gram log-likelihood ratio.

Every document gets base statistics (word characters, symbols, repeated lines and
repeated 8-word windows) and a score: the mean, over its words, of the log ratio
between two multinomials over hashed n-grams, one of trusted documents and one of
the raw corpus.  N-grams are single words (as written, and lower-cased without
punctuation) and pairs of the latter.  An n-gram whose counts don't differ beyond
chance has weight 0, so rare words and the mix of languages have no vote.

Fitting: the trusted multinomial and the threshold come from at most
``LABELLED`` labelled documents of each class (smallest hashes of their ids; a
fifth of the trusted ones is held out of the counts and sets the threshold with
the untrusted ones).  The raw multinomial counts every document.  The threshold is
then one number, applied to every document alike.

Scale: documents are only scanned.  Each counting task sends one table of
``2 ** BITS`` counts in slices, which are summed in two levels; the model is that
one table, whatever the corpus.  Nothing of a document is shuffled.

Defined results: an empty table of documents gives an empty one.  A null or empty text has no words, fails the base rules and
scores 0.  Ids labelled more than once count as untrusted if any label says so;
null labels and labels of absent documents have no effect; without labels every
score is 0 and only the base rules decide.  Repeated documents are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm import textarrays as ta
from corpusmill.llm.common import lean

#: Labelled documents of each class that the fit reads at most.
LABELLED = 50_000
#: The model has ``2 ** BITS`` hashed n-grams.
BITS = 20
_SLICE = 1 << 12
#: An n-gram has a vote if its trusted count is this many standard errors off, for words and pairs ...
Z_WORD, Z_PAIR = 3.0, 8.0
#: ... and the log ratio is at least this.
LEAST_RATIO = 0.7
_PRIOR = 1.0
#: Losing a trusted document weighs as much as keeping this many untrusted ones.
TRUSTED_COST = 10.0
WINDOW = 8

SYMBOLS = ta._table(lambda b: b in b"#*$%&|<>")
_STARTS_CHAR = ta._table(lambda b: b & 0xC0 != 0x80)

RESULT = T.StructType([
    *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType()),
])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  #: of each hashed n-gram, float32
    threshold: float     #: documents below it are rejected


def _features(arr: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, rows, words of each row, hashed n-grams, their rows)`` for each chunk and view."""
    shift = np.uint64(64 - BITS)
    for written, plain in zip(ta.chunks(arr, ta.NON_SPACE, False), ta.chunks(arr, ta.ALNUM_LOWER, True), strict=True):
        a, b = written.word_hashes(), plain.word_hashes()
        row_a, row_b = written.row_of_word(), plain.row_of_word()
        pairs = ta.window_hashes(b, 2)
        inside = row_b[:-1] == row_b[1:] if len(row_b) > 1 else np.zeros(len(pairs), dtype=bool)
        # a third of the table for each kind, so that words and pairs keep their own tests
        grams = np.concatenate(((ta.mix(a + np.uint64(1)) >> shift) % _THIRD,
                                _THIRD + (ta.mix(b + np.uint64(2)) >> shift) % _THIRD,
                                2 * _THIRD + (pairs[inside] >> shift) % _THIRD)).astype(np.int64)
        yield written.row0, written.rows, written.n_words, grams, np.concatenate((row_a, row_b, row_b[:-1][inside]))


_THIRD = np.uint64((1 << BITS) // 3)


def _counts(docs: DataFrame, text: str, doc_id: str, trusted) -> np.ndarray:
    """``[2, 2 ** BITS]``: n-grams of all documents, and of the trusted ones."""
    schema = "slice int, salt int, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), dtype=np.int64)
        for b in batches:
            ids = b.column(doc_id)
            own = np.asarray(pc.fill_null(pc.is_in(ids, value_set=pa.array(trusted.value, ids.type)), False))
            for row0, rows, _, grams, row in _features(b.column(text)):
                total[0] += np.bincount(grams, minlength=1 << BITS)
                mine = own[row0:row0 + rows][row]
                if mine.any():
                    total[1] += np.bincount(grams[mine], minlength=1 << BITS)
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % 64
        cut = total.reshape(2, -1, _SLICE)
        used = [k for k in range(cut.shape[1]) if cut[0, k].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([salt] * len(used), pa.int32()),
                                          pa.array([cut[:, k].tobytes() for k in used], pa.binary())],
                                         names=["slice", "salt", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for s, t, c in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                got = np.frombuffer(c, dtype=np.int64)
                sums[s, t] = sums[s, t] + got if (s, t) in sums else got
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in sums], pa.int32()), pa.array([t for _, t in sums], pa.int32()),
                                          pa.array([c.tobytes() for c in sums.values()], pa.binary())],
                                         names=["slice", "salt", "counts"])

    part = docs.select(doc_id, text).mapInArrow(lean(count), schema)
    by_salt = part.repartition("slice", "salt").mapInArrow(lean(add), schema).withColumn("salt", F.lit(0))
    out = np.zeros((2, (1 << BITS) // _SLICE, _SLICE), dtype=np.int64)
    for r in by_salt.repartition("slice").mapInArrow(lean(add), schema).toLocalIterator():
        out[:, r.slice] = np.frombuffer(r.counts, dtype=np.int64).reshape(2, _SLICE)
    return out.reshape(2, -1)


def _weights(counts: np.ndarray) -> np.ndarray:
    """Log ratios of the trusted and the raw multinomial, 0 where chance can explain them."""
    raw, own = counts.astype(np.float64)
    out = np.zeros(len(raw))
    third = int(_THIRD)
    for k, z in enumerate((Z_WORD, Z_WORD, Z_PAIR)):
        at = slice(k * third, (k + 1) * third)
        if not own[at].sum():
            continue
        expected = raw[at] * (own[at].sum() / raw[at].sum())
        ratio = np.log((own[at] + _PRIOR) / (expected + _PRIOR))
        sure = np.abs(own[at] - expected) >= z * np.sqrt(expected + 1)
        out[at] = np.where(sure & (np.abs(ratio) >= LEAST_RATIO), ratio, 0)
    return out.astype(np.float32)


def _scores(weights: np.ndarray, arr: pa.Array) -> np.ndarray:
    out = np.zeros(len(arr))
    for row0, rows, n_words, grams, row in _features(arr):
        total = np.bincount(row, weights=weights[grams], minlength=rows)
        out[row0:row0 + rows] = total / np.maximum(n_words, 1)
    # scores are compared with a threshold: sums in another order must not decide
    return np.round(out, 9)


def _threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut that catches most of ``bad`` at ``TRUSTED_COST`` for each share of ``good`` lost."""
    if not len(good) or not len(bad):
        return -np.inf
    cuts = np.unique(np.concatenate((good, bad, [0.0])))
    cuts = cuts[cuts <= 0]
    gain = (np.searchsorted(np.sort(bad), cuts) / len(bad)
            - TRUSTED_COST * np.searchsorted(np.sort(good), cuts) / len(good))
    best = int(np.argmax(gain))
    return float(cuts[best]) if gain[best] > 0 else -np.inf


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", labelled: int = LABELLED) -> Model:
    """Fit the ratio and its threshold; ``labels`` has the id, ``quality`` and ``toxic`` (0 or 1)."""
    spark = docs.sparkSession
    known = (labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id"))
             .agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
             .where(F.col("good").isNotNull()))
    sample = {}
    for good in (True, False):
        rows = known.where(F.col("good") == good).orderBy(F.xxhash64("id"), "id").limit(labelled).collect()
        sample[good] = [r.id for r in rows]
    held = set(sample[True][::5])
    fitted = [i for i in sample[True] if i not in held]
    if not fitted:
        return Model(np.zeros(1 << BITS, dtype=np.float32), -np.inf)
    weights = _weights(_counts(docs, text, doc_id, spark.sparkContext.broadcast(fitted)))
    judged = spark.createDataFrame([(i, True) for i in held] + [(i, False) for i in sample[False]],
                                   T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("good", T.BooleanType())]))
    shared = spark.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("good"), pa.array(_scores(shared.value, b.column("words")))],
                                             names=["id", "good", "score"])

    # at most twice ``labelled`` ids: a proven bound, so the broadcast is safe
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("words")).join(F.broadcast(judged), "id")
            .select("id", "good", "words")
            .mapInArrow(lean(score), T.StructType([*judged.schema.fields, T.StructField("score", T.DoubleType())]))
            .groupBy("id", "good").agg(F.min("score").alias("score")).collect())
    return Model(weights, _threshold(np.array([r.score for r in rows if r.good]), np.array([r.score for r in rows if not r.good])))


def _repeats(chunk: ta.Chunk) -> np.ndarray:
    """Words of each text that lie in a window of ``WINDOW`` words found twice or more in that text."""
    covered = np.zeros(len(chunk.start) + 1, dtype=np.int64)
    row = chunk.row_of_word()
    if len(row) >= WINDOW:
        at = np.flatnonzero(row[:-WINDOW + 1] == row[WINDOW - 1:])
        key = ta.window_hashes(chunk.word_hashes(), WINDOW)[at] ^ ta.mix(row[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        np.add.at(covered, at[again], 1)
        np.add.at(covered, at[again] + WINDOW, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(covered)[:-1] > 0)))
    return np.diff(inside[chunk.word_at])


def _dup_lines(raw: bytes) -> int:
    lines = raw.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, again = set(), 0
    for line in lines:
        if line.strip(b" \t\n\v\f\r"):
            again += line in seen
            seen.add(line)
    return again


def base_statistics(arr: pa.Array) -> dict[str, np.ndarray]:
    """The base columns for each text of ``arr``."""
    parts = []
    for c in ta.chunks(arr, ta.NON_SPACE, False):
        upto = lambda marks: np.diff(np.concatenate(([0], np.cumsum(marks)))[c.text_at])  # noqa: E731, B023
        lines = [_dup_lines(c.bytes[a:b].tobytes()) for a, b in zip(c.text_at[:-1], c.text_at[1:], strict=True)]
        parts.append((c.n_words, upto(ta.NON_SPACE[c.bytes] & _STARTS_CHAR[c.bytes]), upto(SYMBOLS[c.bytes]), lines, _repeats(c)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = {n: np.concatenate([p[k] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for k, n in enumerate(names)}
    out["base_failed"] = (out["n_words"] < 20) | (100 * out["n_repeat_words"] > 30 * out["n_words"])
    return out


def judge(docs: DataFrame, model: Model, text: str = "text", mode: str = "annotate") -> DataFrame:
    """``annotate`` adds the columns of ``RESULT`` (an equally named column of ``docs``
    gives way); ``filter`` returns the kept rows of ``docs`` unchanged."""
    results = {f.name.lower() for f in RESULT.fields}
    kept = [c for c in docs.columns if mode == "filter" or c.lower() not in results or c == text]
    schema = T.StructType([docs.schema[c] for c in kept] + ([] if mode == "filter" else list(RESULT.fields)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = base_statistics(b.column(text))
            got["score"] = _scores(m.weights, b.column(text))
            got["kept"] = ~got["base_failed"] & (got["score"] >= m.threshold)
            own = [b.column(c) for c in kept]
            if mode == "filter":
                yield pa.RecordBatch.from_arrays([pc.filter(c, pa.array(got["kept"])) for c in own], names=kept)
            else:
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(got[f.name]) for f in RESULT.fields)], names=schema.names)

    return docs.mapInArrow(lean(run), schema)
