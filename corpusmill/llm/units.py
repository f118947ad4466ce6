"""Substring deduplication by hashing lines, sentences or paragraphs.

A text is cut into units at newlines, at newlines and at spaces after a full stop or an
exclamation or question mark (``sentence``: passages match whose line breaks differ), or
at blank lines.  A unit is normalised to
its words (A-Z lower-cased, cut at every other ASCII character) and hashed to 128
bits.  Of all occurrences of a unit in the corpus, the one ranked first - smallest
document id, then position - stays; the others are cut out, and their character
ranges in the original text are returned.

Scale: texts are scanned twice; between the scans only digests move.  First
occurrences are minima, summed map-side; a unit in a third of all documents is a
skewed join key that can be split.  Each document's cuts are bounded by its units.
Texts are shuffled once, to meet their cuts.

Defined results: units of fewer than ``min_words`` words (1: only those without a word)
always stay, as do those of a document without an id, which also count as no occurrence.
An empty table gives an empty one.  A null text stays
null, an empty one empty.  Rows with one id are copies of one document: equal units
at one place in them are one occurrence.  Ties can't occur otherwise.  Columns of
the documents that share the name of a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm import textarrays as ta
from corpusmill.llm.common import free_name, lean

MIN_WORDS = 1
_RANGE = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())])
RESULT = T.StructType([T.StructField("n_units", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("removed", T.ArrayType(_RANGE)), T.StructField("longest", T.LongType())])
_STARTS_CHAR = ta._table(lambda b: b & 0xC0 != 0x80)


#: Marks that end a sentence if a space follows.
_ENDS = ta._table(lambda b: b in b".!?")


def _cuts(chunk: ta.Chunk, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, text)`` of each unit in bytes of the chunk; separators belong to no unit."""
    line = np.flatnonzero(chunk.bytes == 0x0A)
    if unit == "sentence":
        space = np.flatnonzero(chunk.bytes == 0x20)
        space = space[~np.isin(space, chunk.text_at)]  # a text's first byte has none before it
        line = np.sort(np.concatenate((line, space[_ENDS[chunk.bytes[space - 1]]])))
    if unit == "paragraph":  # a run of two or more newlines separates
        of = np.searchsorted(chunk.text_at, line, side="right")
        run = np.split(line, np.flatnonzero((np.diff(line) != 1) | (np.diff(of) != 0)) + 1) if len(line) else []
        run = [r for r in run if len(r) > 1]
        stop, go = np.array([r[0] for r in run], dtype=np.int64), np.array([r[-1] + 1 for r in run], dtype=np.int64)
    else:
        stop, go = line, line + 1
    start = np.concatenate((chunk.text_at[:-1], go))
    end = np.concatenate((stop, chunk.text_at[1:]))
    text = np.concatenate((np.arange(chunk.rows), np.searchsorted(chunk.text_at, go - 1, side="right") - 1)).astype(np.int64)
    text_e = np.concatenate((np.searchsorted(chunk.text_at, stop, side="right") - 1, np.arange(chunk.rows))).astype(np.int64)
    order, order_e = np.lexsort((start, text)), np.lexsort((end, text_e))
    return start[order], np.maximum(end[order_e], start[order]), text[order]


def _prefix(words: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = ta._POWERS.upto(len(words) + 1)
    upto = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(ta.mix(words + np.uint64(salt)) * up[:len(words)], dtype=np.uint64, out=upto[1:])
    return upto, down


def units(arr: pa.Array, unit: str) -> Iterator[tuple[ta.Chunk, np.ndarray, ...]]:
    """``(chunk, start, end, text, number in its text, high, low, words)`` for each chunk's units."""
    for c in ta.chunks(arr, ta.ALNUM_LOWER, True):
        start, end, text = _cuts(c, unit)
        number = np.arange(len(text)) - np.searchsorted(text, text, side="left")
        first, last = np.searchsorted(c.start, start, side="left"), np.searchsorted(c.start, end, side="left")
        words, length = c.word_hashes(), (last - first).astype(np.uint64)
        halves = []
        for salt in (0x1F83D9AB, 0x5BE0CD19):
            upto, down = _prefix(words, salt)
            halves.append(ta.mix((upto[last] - upto[first]) * down[first] + length))
        yield c, start, end, text, number, halves[0].view(np.int64), halves[1].view(np.int64), last - first


def _occurrences(docs: DataFrame, text: str, doc_id: str, unit: str, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, _, _, of, number, high, low, words in units(b.column("text"), unit):
                at = np.flatnonzero(words >= max(min_words, 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(c.row0 + of[at])), pa.array(number[at], pa.int32()), pa.array(high[at]), pa.array(low[at])],
                    names=["id", "unit", "high", "low"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return (docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
            .mapInArrow(lean(run), f"id {kind}, unit int, high long, low long"))


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, and the columns of ``RESULT``:
    the number of units, of removed ones, their ranges in the original text, and the words
    of the longest passage removed (units in a row; those without a word don't break it)."""
    if unit not in ("line", "sentence", "paragraph"):
        raise ValueError(f"unit {unit!r}")
    found = _occurrences(docs, text, doc_id, unit, min_words)
    first = (found.groupBy("high", "low").agg(F.min(F.struct("id", "unit")).alias("first"), F.count("*").alias("many"))
             .where("many > 1").select("high", "low", "first"))
    # rows with one id give equal occurrences, which stay or go together
    lost = (found.join(first, ["high", "low"]).where((F.col("id") != F.col("first.id")) | (F.col("unit") != F.col("first.unit")))
            .select("id", "unit", "low").distinct())
    key, cuts = free_name("_key", docs.columns), free_name("_cuts", docs.columns)
    cut = lost.groupBy(F.col("id").alias(key)).agg(F.collect_list(F.struct("unit", "low")).alias(cuts))
    names = {f.name for f in RESULT.fields}
    kept = [c for c in docs.columns if c in (text, doc_id) or c.lower() not in names]
    schema = T.StructType([*(docs.schema[c] for c in kept), *RESULT.fields])
    joined = docs.select(*kept).join(cut, docs[doc_id] == F.col(key), "left").drop(key)
    ranges = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            todo = [{(u["unit"], u["low"]) for u in v or ()} for v in b.column(cuts).to_pylist()]
            values = b.column(text)
            changed, count, removed, longest = {}, [], [[]] * b.num_rows, [0] * b.num_rows
            for c, start, end, of, number, _, low, words in units(values, unit):
                count.extend(np.bincount(of, minlength=c.rows).tolist())
                bounds = np.searchsorted(of, np.arange(c.rows + 1))
                for r in (r for r in range(c.rows) if todo[c.row0 + r]):
                    raw, base = values[c.row0 + r].as_py().encode(), c.text_at[r]
                    own = [(int(start[k] - base), int(end[k] - base), words[k] >= max(min_words, 1) and (int(number[k]), int(low[k])) in todo[c.row0 + r])
                           for k in range(bounds[r], bounds[r + 1])]
                    chars = np.concatenate(([0], np.cumsum(_STARTS_CHAR[np.frombuffer(raw, dtype=np.uint8)])))
                    removed[c.row0 + r] = [{"first": int(chars[s]), "end": int(chars[e])} for s, e, gone in own if gone]
                    passage = 0
                    for n, (_, _, gone) in zip(words[bounds[r]:bounds[r + 1]].tolist(), own, strict=True):
                        passage = passage + n if gone or not n else 0
                        longest[c.row0 + r] = max(longest[c.row0 + r], passage)
                    kept_units = [(s, e) for s, e, gone in own if not gone]
                    if unit == "paragraph":
                        left = b"\n\n".join(raw[s:e] for s, e in kept_units)
                    else:  # each with the separator before it, but for the first
                        left = b"".join(raw[max(s - 1, 0) if k else s:e] for k, (s, e) in enumerate(kept_units))
                    changed[c.row0 + r] = left.decode()
            count = [0 if not v.is_valid else n for v, n in zip(values, count, strict=True)]
            if changed:
                values = pa.array([changed.get(r, v) for r, v in enumerate(values.to_pylist())], values.type)
            own = {**{k: b.column(k) for k in kept}, text: values}
            yield pa.RecordBatch.from_arrays([*(own[k] for k in kept), pa.array(count, pa.int64()),
                                              pa.array([len(r) for r in removed], pa.int64()), pa.array(removed, ranges), pa.array(longest, pa.int64())],
                                             names=schema.names)

    return joined.mapInArrow(lean(run), schema)
