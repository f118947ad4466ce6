"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Items are normalised (A-Z lower-cased, words cut at every other ASCII character)
and cut into windows of ``n`` words; an item with fewer words is one window.  The
windows' hashes are broadcast, documents are scanned once, and every hash hit is
verified against the window's own words before it counts.

Scale: documents are only scanned - no shuffle at any size.  The broadcast holds
at most ``BLOCK_WINDOWS`` windows.  A benchmark with more is dealt over several
blocks by hash; then documents pass through one scan per block, hits are kept as
an extra column of the stored rows, and the verdict is taken after the last.

Defined results: an empty table of documents gives an empty one, and by an empty
benchmark nothing is hit.  A null or empty text has no words and is never contaminated; an
item without words has no window; an item with a null id marks words as hit but
isn't listed; items with equal ids count once.  Repeated documents are judged one
by one.  Columns of the documents besides the text column are carried along; one
whose name equals a result column (in any case) is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm import textarrays as ta
from corpusmill.llm.common import free_name, lean, lower_ascii, stored

N = 13
#: Windows in one broadcast: about 200 MB with their words in Python.
BLOCK_WINDOWS = 1 << 19
_FILTER_BITS = 20

_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("contaminated", T.BooleanType()), T.StructField("hit_spans", _SPANS),
])
_ARROW_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def item_windows(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", n: int = N) -> DataFrame:
    """``(window, n, item)``: every distinct window of every item, its words joined by spaces."""
    words = F.expr("filter(ws, w -> w <> '')")
    cut = (benchmark.select(F.col(item_id).cast("string").alias("item"),
                            F.split(lower_ascii(F.col(text)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+").alias("ws"))
           .select("item", words.alias("ws")).where("size(ws) > 0")
           .withColumn("n", F.least(F.size("ws"), F.lit(n))))
    at = F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("n") + 1))
    return (cut.select("item", "ws", "n", at.alias("at"))
            .select(F.array_join(F.expr("slice(ws, at, n)"), " ").alias("window"), "n", "item").distinct())


class WindowSet:
    """Windows by hash, with a bit filter in front and their words behind."""

    def __init__(self, rows):
        self.items: dict[bytes, set[str]] = {}
        lengths: dict[int, list[bytes]] = {}
        for window, n, item in rows:
            key = window.encode()
            if key not in self.items:
                self.items[key] = set()
                lengths.setdefault(n, []).append(key)
            if item is not None:
                self.items[key].add(item)
        self.by_length = {}
        for n, keys in lengths.items():
            words = np.concatenate([c.word_hashes() for c in ta.chunks(
                pa.array([w for k in keys for w in k.split(b" ")], pa.binary()), ta.ALNUM_LOWER, False)])
            hashes = np.unique(ta.window_hashes(words, n)[::n])
            bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
            bits[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.by_length[n] = (hashes, bits)

    def hits(self, chunk: ta.Chunk) -> tuple[np.ndarray, dict[int, set[str]]]:
        """A mark for each word inside a window, and the items of each text."""
        marks = np.zeros(len(chunk.start) + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        if not len(chunk.start):
            return marks[:-1] > 0, items
        words, row = chunk.word_hashes(), chunk.row_of_word()
        for n, (hashes, bits) in self.by_length.items():
            found = ta.window_hashes(words, n)
            at = np.flatnonzero(bits[(found >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            at = at[row[at] == row[at + n - 1]] if len(at) else at
            if not len(at):
                continue
            near = np.searchsorted(hashes, found[at])
            at = at[hashes[np.minimum(near, len(hashes) - 1)] == found[at]]
            for k in at.tolist():
                got = self.items.get(chunk.joined(k, n))
                if got is not None:
                    marks[k] += 1
                    marks[k + n] -= 1
                    items.setdefault(int(row[k]), set()).update(got)
        return np.cumsum(marks)[:-1] > 0, items


def _runs(marked: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], marked, [False])).astype(np.int8)))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _scan(windows: WindowSet, arr: pa.Array) -> tuple[list[int], dict[int, tuple[list[dict], set[str]]], dict]:
    """Words of each row; hit word spans and items of the rows with hits; their chunks' word bounds."""
    n_words, hits, bounds = [], {}, {}
    for chunk in ta.chunks(arr, ta.ALNUM_LOWER, True):
        marks, items = windows.hits(chunk)
        n_words.extend(chunk.n_words.tolist())
        at = chunk.word_at
        rows = np.unique(chunk.row_of_word()[marks]) if marks.any() else []
        for r in map(int, rows):
            own = slice(at[r], at[r + 1])
            hits[chunk.row0 + r] = (_runs(marks[own]), items.get(r, set()))
            bounds[chunk.row0 + r] = (chunk.start[own] - chunk.text_at[r], chunk.end[own] - chunk.text_at[r])
    return n_words, hits, bounds


def _verdict(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def _merged(a: list[dict], b: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted([*a, *b], key=lambda s: (s["first"], s["last"])):
        if out and s["first"] <= out[-1]["last"] + 1:
            out[-1] = {"first": out[-1]["first"], "last": max(out[-1]["last"], s["last"])}
        else:
            out.append(dict(s))
    return out


def _without(text: str, spans: list[dict], start: np.ndarray, end: np.ndarray) -> str:
    raw, at, kept = text.encode(), 0, []
    for s in spans:
        kept.append(raw[at:start[s["first"]]])
        at = end[s["last"]]
    return b"".join([*kept, raw[at:]]).decode()


def _window_blocks(windows: DataFrame, block_windows: int):
    """Broadcast window sets that together hold all windows, each of a checked size."""
    spark = windows.sparkSession
    windows = stored(windows, "windows")
    blocks = max(1, -(-windows.count() // max(1, block_windows // 2)))
    for k in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        yield blocks, spark.sparkContext.broadcast(WindowSet((r.window, r.n, r.item) for r in part.toLocalIterator()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text",
                  item_id: str = "item_id", n: int = N, mode: str = "annotate",
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Find benchmark passages in ``docs``.

    ``mode``: ``annotate`` adds the columns of ``RESULT`` (``hit_spans`` are ranges
    of word numbers); ``documents`` returns the rows of documents that aren't
    contaminated, unchanged; ``spans`` cuts the hit words out of contaminated
    documents.  A document is contaminated if a word is hit and hits are at least
    a twentieth of its words.
    """
    if mode not in ("annotate", "documents", "spans"):
        raise ValueError(f"mode {mode!r}")
    sets = _window_blocks(item_windows(benchmark, item_text, item_id, n), block_windows)
    held, earlier, spans, items = docs, docs.columns, "", ""
    for k, (blocks, index) in enumerate(sets):
        if k + 1 < blocks:  # more blocks follow: carry what this one found along with the rows
            spans, items = spans or free_name("_spans", earlier), items or free_name("_items", earlier)
            held = stored(_carry(held, index, text, spans, items, first=k == 0), "decontaminate")
        else:
            return _finish(held, earlier, index, text, spans, items, mode)
    raise AssertionError("there is always one block")


def _carry(docs: DataFrame, index, text: str, spans: str, items: str, first: bool) -> DataFrame:
    schema = docs.schema if not first else T.StructType(
        [*docs.schema.fields, T.StructField(spans, _SPANS), T.StructField(items, T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            before = [([], set())] * b.num_rows if first else [
                (s or [], set(i or [])) for s, i in zip(b.column(spans).to_pylist(), b.column(items).to_pylist(), strict=True)]
            _, hits, _ = _scan(index.value, b.column(text))
            after = [(_merged(s, hits[r][0]), i | hits[r][1]) if r in hits else (s, i) for r, (s, i) in enumerate(before)]
            own = [c for name, c in zip(b.schema.names, b.columns, strict=True) if name not in (spans, items)]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array([s for s, _ in after], _ARROW_SPANS), pa.array([sorted(i) for _, i in after], pa.list_(pa.string()))],
                names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def _finish(docs: DataFrame, columns: list[str], index, text: str, spans: str, items: str, mode: str) -> DataFrame:
    results = {f.name.lower() for f in RESULT.fields}
    kept = [c for c in columns if mode != "annotate" or c.lower() not in results or c == text]
    schema = T.StructType([docs.schema[c] for c in kept] + (list(RESULT.fields) if mode == "annotate" else []))
    found = [f.name for f in RESULT.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, hits, bounds = _scan(index.value, b.column(text))
            if spans:
                for r, (s, i) in enumerate(zip(b.column(spans).to_pylist(), b.column(items).to_pylist(), strict=True)):
                    if s or i:
                        h = hits.get(r, ([], set()))
                        hits[r] = (_merged(s or [], h[0]), set(i or []) | h[1])
            n_hit = {r: sum(s["last"] - s["first"] + 1 for s in h[0]) for r, h in hits.items()}
            bad = [_verdict(n_hit.get(r, 0), n) for r, n in enumerate(n_words)]
            arrays = {c: b.column(c) for c in kept}
            if mode == "documents":
                keep = pa.array([not x for x in bad], pa.bool_())
                yield pa.RecordBatch.from_arrays([pc.filter(arrays[c], keep) for c in kept], names=kept)
                continue
            if mode == "spans" and any(bad):
                lost = [r for r, x in enumerate(bad) if x and r not in bounds]
                for r in lost:  # hit by an earlier block only: its word bounds weren't kept
                    chunk = next(ta.chunks(b.column(text).slice(r, 1), ta.ALNUM_LOWER, True))
                    bounds[r] = (chunk.start, chunk.end)
                values = b.column(text).to_pylist()
                arrays[text] = pa.array([_without(v, hits[r][0], *bounds[r]) if bad[r] else v for r, v in enumerate(values)],
                                        b.schema.field(text).type)
            got = {}
            if mode == "annotate":
                ids = [sorted(hits[r][1]) if r in hits else [] for r in range(b.num_rows)]
                got = {"n_words": pa.array(n_words, pa.int64()),
                       "n_hit": pa.array([n_hit.get(r, 0) for r in range(b.num_rows)], pa.int64()),
                       "n_items": pa.array([len(i) for i in ids], pa.int64()), "item_ids": pa.array(ids, pa.list_(pa.string())),
                       "contaminated": pa.array(bad, pa.bool_()),
                       "hit_spans": pa.array([hits[r][0] if r in hits else [] for r in range(b.num_rows)], _ARROW_SPANS)}
            yield pa.RecordBatch.from_arrays([*[arrays[c] for c in kept], *[got[c] for c in found if got]], names=schema.names)

    return docs.mapInArrow(lean(run), schema)
