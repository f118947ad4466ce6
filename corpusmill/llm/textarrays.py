"""Words, word hashes and shingles of whole Arrow string batches, as numpy arrays.

A batch is cut into chunks of whole texts of about ``CHUNK_BYTES``; every array
of a chunk is made by a few vector operations, so no Python code runs per word.
Texts are handled as UTF-8 bytes: the word patterns in use treat every byte of a
non-ASCII character alike, so cutting bytes and cutting characters agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LEN = np.uint64(0xD6E8FEB86659FD93)


def _table(member) -> np.ndarray:
    return np.fromiter((member(b) for b in range(256)), dtype=bool, count=256)


#: ``[^\x20\x09-\x0D]``
NON_SPACE = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: digits, a-z and all that is not ASCII
ALNUM_LOWER = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 step)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                a = np.full(size, base, dtype=np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Chunk:
    """Whole texts of consecutive rows and their words."""

    row0: int            #: row of the first text within the batch
    bytes: np.ndarray    #: the texts' bytes, lower-cased if asked for
    text_at: np.ndarray  #: byte offset of each text and of the end
    start: np.ndarray    #: first byte of each word
    end: np.ndarray      #: byte after each word
    word_at: np.ndarray  #: number of the first word of each text, and of all words

    @property
    def rows(self) -> int:
        return len(self.text_at) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_at)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.n_words)

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.bytes)
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        up, down = _POWERS.upto(n + 1)
        upto = np.empty(n + 1, dtype=np.uint64)
        upto[0] = 0
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=upto[1:])
        raw = (upto[self.end] - upto[self.start]) * down[self.start]
        return mix(raw + (self.end - self.start).astype(np.uint64) * _LEN)

    def joined(self, first: int, count: int) -> bytes:
        """``count`` words from word number ``first``, joined by single spaces."""
        return b" ".join(self.bytes[s:e].tobytes() for s, e in
                         zip(self.start[first:first + count], self.end[first:first + count], strict=True))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each window of ``n`` consecutive words (no regard to texts)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    factor = 1
    for k in range(n):
        factor = (factor * _BASE) & ((1 << 64) - 1)
        out += words[k:k + count] * np.uint64(factor)
    return mix(out)


def string_parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary array; a null has no bytes."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not (pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)):
        arr = arr.cast(pa.large_string() if pa.types.is_string(arr.type) else pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_large_string(arr.type) else b"")
    _, offsets, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    at = np.frombuffer(offsets, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return at - at[0], raw[at[0]:at[-1]]


def chunks(arr: pa.Array, letters: np.ndarray, lower: bool, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut the texts of ``arr`` into chunks; ``letters`` marks the bytes of words."""
    at, data = string_parts(arr)
    row, rows = 0, len(at) - 1
    while row < rows:
        last = int(np.searchsorted(at, at[row] + size, side="right")) - 1
        last = min(max(last, row + 1), rows)
        part = data[at[row]:at[last]]
        if lower:
            part = _LOWER[part]
        text_at = at[row:last + 1] - at[row]
        inside = letters[part]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        # a word also ends where its text ends: cut there whenever both sides are word bytes
        inner = text_at[1:-1]
        inner = inner[(inner > 0) & (inner < len(part))]
        joint = np.unique(inner[inside[inner - 1] & inside[inner]]) if len(inner) else inner
        starts = edge[inside[edge]]
        ends = edge[~inside[edge]]
        if len(part) and inside[0]:
            starts = np.concatenate(([0], starts))
        if len(part) and inside[-1]:
            ends = np.concatenate((ends, [len(part)]))
        if len(joint):
            starts = np.sort(np.concatenate((starts, joint)))
            ends = np.sort(np.concatenate((ends, joint)))
        word_at = np.searchsorted(starts, text_at, side="left")
        word_at[-1] = len(starts)
        yield Chunk(row, part, text_at, starts.astype(np.int64), ends.astype(np.int64), word_at)
        row = last
