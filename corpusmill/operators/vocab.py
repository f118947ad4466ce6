"""Character vocabulary and the character codec.

The vocabulary is the set of distinct characters sorted by code point with
dense ids from 0.  Its size is bounded by the alphabet (at most 1,114,112
code points), which is what makes the single ordered window in ``char_vocab``
and the driver-side lookup array in the codec safe at any corpus size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.profile import char_array

VOCAB_COLLECT_LIMIT = 1_114_112  # the whole code space: a proven upper bound


def char_vocab(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct characters in code-point order with dense ids ``(id INT, ch STRING)``.

    Rows are reduced to their distinct characters first and the global
    distinct uses a map-side aggregate, so only the alphabet is shuffled.
    UTF-8 byte order equals code-point order, so ``ORDER BY ch`` is exact.
    """
    chars = (df.select(F.explode(F.array_distinct(char_array(text_col))).alias("ch"))
             .distinct())
    w = Window.orderBy("ch")  # bounded: one row per distinct code point
    return chars.select((F.row_number().over(w) - 1).cast("int").alias("id"), "ch")


def char_frequency(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Occurrences of every character ``(ch, n)``."""
    return (df.select(F.explode(char_array(text_col)).alias("ch"))
            .groupBy("ch").agg(F.count(F.lit(1)).alias("n")))


def vocab_stats(vocab: DataFrame, n: int = 20) -> DataFrame:
    """Vocabulary size and the first ``n`` symbols in id order, joined."""
    return vocab.agg(
        F.count(F.lit(1)).alias("vocab_size"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("id") < n, F.struct("id", "ch")))),
                lambda s: s["ch"]), "").alias("head"))


def _vocab_rows(vocab: DataFrame):
    rows = vocab.select("id", "ch").limit(VOCAB_COLLECT_LIMIT + 1).collect()
    if len(rows) > VOCAB_COLLECT_LIMIT:
        raise ValueError("more symbols than there are characters: not a character vocabulary")
    return rows


class CharCodec:
    """Encode text to ids and back with a fixed character vocabulary.

    The vocabulary (bounded by the alphabet) is read once on the driver and
    turned into literal arrays inside the expression: a code point indexes pages of
    ids, an id indexes the character array.  Both sides stay
    narrow - no join, no shuffle of the corpus.
    """

    def __init__(self, vocab: DataFrame | list):
        rows = vocab if isinstance(vocab, list) else _vocab_rows(vocab)
        pairs = sorted((int(r[0]), r[1]) for r in rows)
        self.size = len(pairs)
        self.chars = [ch for _, ch in pairs]
        if [i for i, _ in pairs] != list(range(self.size)):
            raise ValueError("vocabulary ids must be dense from 0")
        self.max_cp = max((ord(ch) for ch in self.chars), default=0)
        self._id_lookup = None
        self._ch_lookup = None

    # literal arrays, folded to a single constant by the optimizer
    def _ids_by_code_point(self) -> Column:
        """Pages of 256 code points, empty where the vocabulary has none: one path
        for every character, and as many entries as there are pages in use."""
        if self._id_lookup is None:
            pages: dict[int, list[str]] = {}
            for i, ch in enumerate(self.chars):
                pages.setdefault(ord(ch) >> 8, ["NULL"] * 256)[ord(ch) & 255] = str(i)
            every = (f"array({','.join(pages[k])})" if k in pages else "array()" for k in range((self.max_cp >> 8) + 1))
            self._id_lookup = F.expr(f"cast(array({','.join(every)}) as array<array<int>>)")
        return self._id_lookup

    def _chars_by_id(self) -> Column:
        if self._ch_lookup is None:
            self._ch_lookup = F.array(*[F.lit(ch) for ch in self.chars]) if self.chars else \
                F.expr("cast(array() as array<string>)")
        return self._ch_lookup

    def encode(self, c) -> Column:
        """Ids of the characters present in the vocabulary; unknown characters
        are dropped silently (D3)."""
        lookup = self._ids_by_code_point()
        ids = F.transform(char_array(c), lambda ch: F.try_element_at(
            F.try_element_at(lookup, F.shiftright(F.ascii(ch), 8) + 1), F.ascii(ch).bitwiseAND(255) + 1))
        return F.filter(ids, lambda x: x.isNotNull())

    def decode(self, c) -> Column:
        """Characters of known ids, unknown ids dropped silently."""
        arr = self._chars_by_id()
        n = self.size
        col = F.col(c) if isinstance(c, str) else c
        return F.array_join(
            F.transform(col, lambda i: F.when((i >= 0) & (i < n), F.try_element_at(arr, (i + 1).cast("int")))),
            "")


def char_encode(df: DataFrame, vocab: DataFrame, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    codec = CharCodec(vocab)
    return df.withColumn(out_col, codec.encode(F.col(text_col)))


def char_decode(df: DataFrame, vocab: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    codec = CharCodec(vocab)
    return df.withColumn(out_col, codec.decode(F.col(ids_col)))


def roundtrip_mismatches(df: DataFrame, vocab: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: rows checked and rows where decode(encode(text)) differs."""
    codec = CharCodec(vocab)
    dec = codec.decode(codec.encode(F.col(text_col)))
    return df.agg(F.count(F.lit(1)).alias("rows_checked"),
                  F.count_if(~F.col(text_col).eqNullSafe(dec)).alias("mismatches"))
