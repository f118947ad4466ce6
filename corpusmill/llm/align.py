"""Links between the tokens that two tokenizers make of the same text.

A text is encoded with a space in front of it by a byte-level BPE (A) and by a
sentence-piece BPE with byte fallback (B).  Where an A token and a B token end at one
byte, the text is cut; the tokens between two cuts are a group, and every A token of
a group is linked with every B token of it.

Method: fragments that form a monoid.  The tokens that end in a byte range make a
``Fragment``: an open prefix (what closes at the range's first cut), closed groups,
and an open suffix (what follows its last cut).  ``Fragment.then`` joins two
neighbours: the left one's suffix and the right one's prefix become a closed group.
It is associative, so the fragments of a document may be joined in any tree.

* Documents of up to ``FRAGMENT`` bytes: the task that reads them encodes a run of
  them and makes one fragment of it (each document's end is a cut).
* Longer ones are first stored in slices, cut before a single space between two
  characters that are no white space (neither tokenizer joins anything across it).
  Slices are dealt out and encoded by different tasks, whose fragments of fixed byte
  ranges are joined ``FAN`` at a time, level by level.

A document's distinct pairs are stored with its counts, so texts are encoded once.
Counts of id pairs: each task sums the pairs of its documents, and Spark the tasks' sums.  Pairs that make up 1 / ``HOT`` of all (at most ``HOT`` by that) and each
A id's highest count (at most A's vocabulary) are broadcast; the scanning task scores
these links.  Links of other pairs, none of which is frequent, meet their counts in a
join.  Texts are never shuffled, but for the slices of long ones.

Defined results: a null or empty text, and one that a tokenizer does not give back
byte for byte, has no tokens: zeros and ''.  Special tokens' strings in a text are
plain text.  Rows with one id, or with none, are documents of their own; repeated
rows count each.  A text of any length is encoded whole; its tokens make one row in
the end, as its text did.  Ties for an A id's highest count all are best.  An empty
table gives an empty result.  Other columns of the documents are not read, so their
names can't clash.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stored
from corpusmill.operators.bpe import byte_standins

#: Bytes of a range, and of a document that one task handles whole.
FRAGMENT = 1 << 16
#: Fragments joined by one task at each level.
FAN = 8
#: A pair that holds this share of all pairs is scored where it is scanned.
HOT = 1 << 17
#: Bytes of text encoded at once; units that a task remembers, and their length at most.
RUN = 1 << 19
UNITS, UNIT_CHARS = 200_000, 48
#: Links expanded at once, and pairs that a task sums before it passes them on.
LINKS = 1 << 20
SUMS = 1 << 20

_INT, _PAIR = np.dtype("<i4"), np.dtype("<u4")


# ---- tokens ------------------------------------------------------------------------------------

@dataclass
class Tokens:
    """Ids and byte lengths of both tokenizers' tokens over one run of bytes."""

    a: np.ndarray
    a_len: np.ndarray
    b: np.ndarray
    b_len: np.ndarray


#: Fixed value: how the byte-level tokenizer splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class no version of Unicode has changed, so both of A's encoders agree.
_COMMON = re.compile("[\t\n\r -~\u00A1-\u00AC\u00AE-\u024F]*")


def _solid(c: str) -> bool:
    """No white space, control or format character by any table, nor the mark for a space."""
    return "!" <= c <= "~" or (unicodedata.category(c)[0] not in "ZC" and c != "▁")


class Encoders:
    """Both tokenizers; remembers the tokens of the units seen last.

    A unit is what lies between two safe places: single spaces between solid
    characters.  A unit's tokens don't depend on its neighbours.  Units of common
    characters go to a faster encoder made of A's own vocabulary.
    """

    def __init__(self, a_json: str, b_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        of = {c: i for i, c in enumerate(byte_standins())}
        entries = self.a.get_vocab(with_added_tokens=False)
        self.n_a, self.n_b = max(self.a.get_vocab().values()) + 1, self.b.get_piece_size()
        ranks = {bytes(of[c] for c in s): i for s, i in entries.items()}
        self.a_bytes = [b""] * self.n_a
        for s, i in ranks.items():
            self.a_bytes[i] = s
        self.a_size = np.array([len(x) for x in self.a_bytes], _INT)
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_size = np.array([len(x) for x in self.b_bytes], _INT)
        # a piece with a space after another character could lie across a safe place
        self.split = not any(p.lstrip("▁").count("▁") for p in pieces)
        model, before = json.loads(a_json)["model"], json.loads(a_json).get("pre_tokenizer") or {}
        made = [entries["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        by_rank = made == sorted(made) and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.fast = Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if by_rank and not model.get("ignore_merges") else None
        self.known: dict = {}
        self.older: dict = {}

    def _apart(self, u: str) -> tuple:
        """The packed ids of one unit by both tokenizers; empty if one doesn't give it back."""
        one = self.fast.encode_ordinary(" " + u) if self.fast and _COMMON.fullmatch(u) else self.a.encode(" " + u, add_special_tokens=False).ids
        two, raw = self.b.encode(u), b" " + u.encode()
        same = b"".join([self.a_bytes[i] for i in one]) == raw == b"".join([self.b_bytes[i] for i in two])
        return (array("i", one).tobytes(), array("i", two).tobytes()) if same else ()

    def _together(self, units: list[str]) -> list[tuple]:
        """As ``_apart`` for each of many solid units of common characters, at once: a token ends where each unit does."""
        text = " " + " ".join(units)
        one = np.array(self.fast.encode_ordinary(text), _INT)
        lists = self.b.encode(units, num_threads=1)
        two = np.array([i for x in lists for i in x], _INT)
        raw = text.encode()
        if b"".join([self.a_bytes[i] for i in one.tolist()]) != raw or b"".join([self.b_bytes[i] for i in two.tolist()]) != raw:
            return [self._apart(u) for u in units]
        wide = _INT.itemsize
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        a_at = [0, *(np.searchsorted(np.cumsum(self.a_size[one]), ends, side="right") * wide).tolist()]
        b_at = [0, *(np.cumsum([len(x) for x in lists]) * wide).tolist()]
        a, b = one.tobytes(), two.tobytes()
        return [(a[i:j], b[k:n]) for i, j, k, n in zip(a_at, a_at[1:], b_at, b_at[1:], strict=False)]

    def _units(self, words: list[str]) -> list[str]:
        """Words put together where the place between them isn't safe."""
        out, part = [], [words[0]]
        for w in words[1:]:
            last = part[-1]
            if self.split and last and w and _solid(last[-1]) and _solid(w[0]):
                out.append(" ".join(part))
                part = [w]
            else:
                part.append(w)
        out.append(" ".join(part))
        return out

    def parts(self, texts: list[str]) -> list[list[tuple] | None]:
        """For each text the tokens of its units; None if a tokenizer doesn't give it back."""
        split = [t.split(" ") for t in texts]
        known, older = self.known, self.older
        fresh = [w for w in set().union(*split) if w not in known]
        known.update((w, older[w]) for w in fresh if w in older)
        fresh = [w for w in fresh if w not in older]
        ragged = {w for w in fresh if not (self.split and w and _solid(w[0]) and _solid(w[-1]))}
        common = [w for w in fresh if w not in ragged and self.fast and _COMMON.fullmatch(w)]
        if common:
            known.update(zip(common, self._together(common), strict=True))
        known.update((w, self._apart(w)) for w in set(fresh).difference(ragged, common))
        out, odd = [], {}
        for words in split:
            if ragged and not ragged.isdisjoint(words):  # by units of which some are longer than a word
                units = self._units(words)
                odd.update((u, self._apart(u)) for u in units if u not in odd and (u in ragged or u not in known))
                got = [odd[u] if u in odd else known[u] for u in units]
            else:
                got = [known[w] for w in words]
            out.append(None if () in got else got)
        for w in fresh:
            if len(w) > UNIT_CHARS:
                known.pop(w, None)
        if len(known) > UNITS:  # those not met again before as many others are forgotten
            self.known, self.older = {}, known
        return out

    def tokens(self, parts: list[tuple]) -> Tokens:
        a, b = (np.frombuffer(b"".join([p[k] for p in parts]), _INT) for k in (0, 1))
        return Tokens(a, self.a_size[a], b, self.b_size[b])


# ---- fragments -----------------------------------------------------------------------------------

_NONE = np.zeros(0, _INT)


@dataclass
class Fragment:
    """The tokens that end in a byte range; ``cut`` says whether both kinds end together in it.

    Without a cut all tokens are the prefix.  ``na`` and ``nb`` are the sizes of the
    closed groups, whose ids follow one another in ``a`` and ``b``.
    """

    cut: bool = False
    head_a: np.ndarray = None
    head_b: np.ndarray = None
    a: np.ndarray = None
    b: np.ndarray = None
    na: np.ndarray = None
    nb: np.ndarray = None
    tail_a: np.ndarray = None
    tail_b: np.ndarray = None

    FIELDS = ("head_a", "head_b", "a", "b", "na", "nb", "tail_a", "tail_b")

    def __post_init__(self):
        for name in self.FIELDS:
            if getattr(self, name) is None:
                setattr(self, name, _NONE)

    @classmethod
    def of(cls, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> Fragment:
        at = np.searchsorted(b_end, a_end)
        both = np.flatnonzero(b_end[np.minimum(at, len(b_end) - 1)] == a_end) if len(b_end) else at[:0]
        if not len(both):
            return cls(False, a, b)
        i, j = both + 1, at[both] + 1  # tokens up to each cut
        return cls(True, a[:i[0]], b[:j[0]], a[i[0]:i[-1]], b[j[0]:j[-1]], np.diff(i).astype(_INT), np.diff(j).astype(_INT), a[i[-1]:], b[j[-1]:])

    def then(self, right: Fragment) -> Fragment:
        """This fragment and the one that follows it as one (associative; ``Fragment()`` is neutral)."""
        join = lambda *parts: np.concatenate(parts)
        if not self.cut:
            return Fragment(right.cut, join(self.head_a, right.head_a), join(self.head_b, right.head_b), *(getattr(right, n) for n in self.FIELDS[2:]))
        mid_a, mid_b = join(self.tail_a, right.head_a), join(self.tail_b, right.head_b)
        if not right.cut:
            return Fragment(True, *(getattr(self, n) for n in self.FIELDS[:6]), mid_a, mid_b)
        size = lambda x: np.array([len(x)], _INT)
        return Fragment(True, self.head_a, self.head_b, join(self.a, mid_a, right.a), join(self.b, mid_b, right.b),
                        join(self.na, size(mid_a), right.na), join(self.nb, size(mid_b), right.nb), right.tail_a, right.tail_b)

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(a, b, sizes in a, sizes in b)`` of a fragment that starts at a cut and ends at one."""
        if not self.cut:
            return _NONE, _NONE, _NONE, _NONE
        if len(self.tail_a) or len(self.tail_b):
            raise ValueError("the fragment doesn't end at a cut")
        size = lambda x: np.array([len(x)], _INT)
        return (np.concatenate((self.head_a, self.a)), np.concatenate((self.head_b, self.b)),
                np.concatenate((size(self.head_a), self.na)), np.concatenate((size(self.head_b), self.nb)))


# ---- groups of documents ---------------------------------------------------------------------------

@dataclass
class Groups:
    """The groups of some documents; document ``k`` has those from ``at[k]`` to ``at[k + 1]``."""

    rows: np.ndarray
    a: np.ndarray
    b: np.ndarray
    na: np.ndarray
    nb: np.ndarray
    at: np.ndarray


def _runs(lengths: list[int]) -> Iterator[tuple[int, int]]:
    first = total = 0
    for k, n in enumerate(lengths):
        if total and total + n > RUN:
            yield first, k
            first, total = k, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)


def _groups_of_texts(enc: Encoders, batch: pa.RecordBatch) -> Iterator[Groups]:
    lengths = [0 if n is None else n for n in pc.binary_length(batch.column("text")).to_pylist()]
    for first, end in _runs(lengths):
        texts = batch.column("text").slice(first, end - first).to_pylist()
        found = enc.parts([t or "" for t in texts])
        parts = [p if t and p else [] for t, p in zip(texts, found, strict=True)]
        t = enc.tokens([u for p in parts for u in p])
        a_end, b_end = np.cumsum(t.a_len, dtype=np.int64), np.cumsum(t.b_len, dtype=np.int64)
        a, b, na, nb = Fragment.of(t.a, a_end, t.b, b_end).groups()
        stop = np.cumsum([0] + [n + 1 if p else 0 for n, p in zip(lengths[first:end], parts, strict=True)])
        ends = a_end[np.cumsum(na) - 1] if len(na) else np.zeros(0, np.int64)
        yield Groups(np.arange(first, end), a, b, na, nb, np.searchsorted(ends, stop, side="right"))


def _groups_of_whole(enc: Encoders, batch: pa.RecordBatch) -> Iterator[Groups]:
    for k in range(batch.num_rows):
        a, b, na, nb = (np.frombuffer(batch.column(n)[k].as_py(), _INT) for n in ("a", "b", "na", "nb"))
        yield Groups(np.array([k]), a, b, na, nb, np.array([0, len(na)]))


def _expanded(g: Groups, lo: int, hi: int, a0: int, b0: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """``(group, pair)`` of every link in the groups from ``lo`` to ``hi``."""
    na, nb = g.na[lo:hi].astype(np.int64), g.nb[lo:hi].astype(np.int64)
    each = np.repeat(nb, na)  # links of each A token
    start = np.repeat(np.cumsum(nb) - nb, na)
    where = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(start, each)
    a = np.repeat(g.a[a0:a0 + na.sum()].astype(np.int64), each)
    return np.repeat(np.repeat(np.arange(lo, hi), na), each), a * n_b + g.b[b0 + where]


def links(g: Groups, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, pair, links)`` with a row for each distinct pair of each document, in that order.

    Links are expanded ``LINKS`` at a time; a group with more is expanded by distinct ids.
    """
    many = g.na.astype(np.int64) * g.nb
    doc = np.searchsorted(g.at, np.arange(len(many)), side="right") - 1
    a_at, b_at = np.concatenate(([0], np.cumsum(g.na, dtype=np.int64))), np.concatenate(([0], np.cumsum(g.nb, dtype=np.int64)))
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    span = np.int64(n_a) * n_b
    lo = 0
    while lo < len(many):
        if many[lo] > LINKS:
            ua, ca = np.unique(g.a[a_at[lo]:a_at[lo + 1]], return_counts=True)
            ub, cb = np.unique(g.b[b_at[lo]:b_at[lo + 1]], return_counts=True)
            keys.append((doc[lo] * span + ua.astype(np.int64)[:, None] * n_b + ub).ravel())
            counts.append((ca[:, None] * cb).ravel())
            lo += 1
            continue
        upto = np.cumsum(many[lo:lo + LINKS])
        hi = lo + max(1, int(np.searchsorted(upto, LINKS, side="right")))
        group, pair = _expanded(g, lo, hi, a_at[lo], b_at[lo], n_b)
        k, c = np.unique(doc[group] * span + pair, return_counts=True)
        keys.append(k)
        counts.append(c)
        lo = hi
    if len(keys) == 2:
        key, count = keys[1], counts[1]
    else:
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.zeros(len(key), np.int64)
        np.add.at(count, back, np.concatenate(counts))
    return key // span, key % span, count


class Written:
    """Groups as text: decimal ids, ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, ids: int):
        width = len(str(ids))
        self.digits = np.zeros((ids, width + 1), np.uint8)
        text = np.char.encode(np.arange(ids).astype(str), "ascii").astype(f"S{width}")
        self.digits[:, :width] = text.view(np.uint8).reshape(ids, width)
        self.width = 1 + (self.digits != 0).sum(1)

    def digests(self, g: Groups) -> list[str]:
        """The SHA-256 of each document's groups, '' for one without."""
        a_upto, b_upto = np.cumsum(g.na, dtype=np.int64), np.cumsum(g.nb, dtype=np.int64)
        out = np.empty((len(g.a) + len(g.b), self.digits.shape[1]), np.uint8)
        at_a = np.arange(len(g.a)) + np.repeat(b_upto - g.nb, g.na)
        at_b = np.arange(len(g.b)) + np.repeat(a_upto, g.nb)
        out[at_a], out[at_b] = self.digits[g.a], self.digits[g.b]
        out[:, -1] = ord(",")
        if len(a_upto):
            out[at_a[a_upto - 1], -1], out[at_b[b_upto - 1], -1] = ord("|"), ord(";")
        width = np.empty(len(out), np.int64)
        width[at_a], width[at_b] = self.width[g.a], self.width[g.b]
        size = np.concatenate(([0], np.cumsum(width)))
        raw = out.tobytes().translate(None, b"\0")
        tokens = np.concatenate(([0], a_upto + b_upto))[g.at]  # tokens before each document
        return ["" if s == e else hashlib.sha256(raw[size[s]:size[e] - 1]).hexdigest() for s, e in zip(tokens[:-1], tokens[1:], strict=True)]


# ---- the jobs ----------------------------------------------------------------------------------------

def _slices(text: str, fragment: int) -> Iterator[str]:
    """A long text cut at safe places, one space at each cut left out."""
    first, at = 0, fragment
    while (at := text.find(" ", at)) >= 0:
        if at + 1 < len(text) and at > first and _solid(text[at - 1]) and _solid(text[at + 1]):
            yield text[first:at]
            first, at = at + 1, at + fragment
        else:
            at += 1
    yield text[first:]


def _long_documents(docs: DataFrame, model, kind: str, fragment: int) -> DataFrame:
    """``(key, id, a, b, na, nb)``: the groups of each long document that both tokenizers give back."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, doc, text in zip(b.column("key"), b.column("id"), b.column("text"), strict=True):
                at = 0
                for part in _slices(text.as_py(), fragment):
                    yield pa.RecordBatch.from_arrays([pa.array([key.as_py()], pa.int64()), pa.array([doc.as_py()], b.schema.field("id").type),
                                                      pa.array([at], pa.int64()), pa.array([part])], names=["key", "id", "at", "text"])
                    at += len(part.encode()) + 1

    fields = ", ".join(f"{n} binary" for n in Fragment.FIELDS)
    schema = f"key long, id {kind}, at long, good boolean, cut boolean, {fields}"
    names = [f.split()[0] for f in schema.split(", ")]

    def rows(table: list[list]) -> list[pa.Array]:
        kinds = [pa.int64(), None, pa.int64(), pa.bool_(), pa.bool_(), *[pa.binary()] * len(Fragment.FIELDS)]
        return [pa.array([r[k] for r in table], t) for k, t in enumerate(kinds) if t is not None]

    def packed(f: Fragment) -> list:
        return [f.cut, *(np.ascontiguousarray(getattr(f, n), _INT).tobytes() for n in Fragment.FIELDS)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoders(model)
        for b in batches:
            for k in range(b.num_rows):
                key, at, text = (b.column(n)[k].as_py() for n in ("key", "at", "text"))
                parts = enc.parts([text])[0]
                t = enc.tokens(parts or [])
                a_end, b_end = at + np.cumsum(t.a_len, dtype=np.int64), at + np.cumsum(t.b_len, dtype=np.int64)
                stop = at + len(text.encode()) + 1
                made = []
                for lo in range(at // fragment * fragment, stop, fragment):  # tokens belong to the range that they end in
                    i, j = np.searchsorted(a_end, (lo, lo + fragment), side="right"), np.searchsorted(b_end, (lo, lo + fragment), side="right")
                    f = Fragment.of(t.a[i[0]:i[1]], a_end[i[0]:i[1]], t.b[j[0]:j[1]], b_end[j[0]:j[1]])
                    made.append([key, None, max(lo, at), parts is not None, *packed(f)])
                cols = rows(made)
                cols.insert(1, pa.array([b.column("id")[k].as_py()] * len(made), b.schema.field("id").type))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    def join(group: pa.Table) -> pa.Table:
        order = group.sort_by("at")
        whole = Fragment()
        for k in range(order.num_rows):
            whole = whole.then(Fragment(order.column("cut")[k].as_py(), *(np.frombuffer(order.column(n)[k].as_py(), _INT) for n in Fragment.FIELDS)))
        good = all(order.column("good").to_pylist())
        one = [order.column("key")[0].as_py(), None, order.column("at")[0].as_py(), good, *(packed(whole) if good else packed(Fragment()))]
        cols = rows([one])
        cols.insert(1, order.column("id").slice(0, 1).combine_chunks())
        return pa.Table.from_arrays(cols, names=names)

    parts = stored(docs.mapInArrow(cut, f"key long, id {kind}, at long, text string"), "slices")
    last = parts.agg(F.max("at")).first()[0] or 0
    found = stored(parts.repartition("key", "at").mapInArrow(encode, schema), "fragments")
    span = fragment
    while True:  # a level at a time, until one range holds the longest document
        span *= FAN
        found = stored(found.groupBy("key", F.expr(f"at div {span}").alias("range")).applyInArrow(join, schema), "fragments")
        if last < span:
            break

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                f = Fragment(b.column("cut")[k].as_py(), *(np.frombuffer(b.column(n)[k].as_py(), _INT) for n in Fragment.FIELDS))
                yield pa.RecordBatch.from_arrays([b.column("key").slice(k, 1), b.column("id").slice(k, 1), *(pa.array([x.astype(_INT).tobytes()]) for x in f.groups())],
                                                 names=["key", "id", "a", "b", "na", "nb"])

    return stored(found.mapInArrow(close, f"key long, id {kind}, a binary, b binary, na binary, nb binary"), "aligned")


_ENCODERS: dict = {}


def _encoders(model) -> Encoders:
    """One pair of encoders in a worker, with the units that it has met."""
    if model.value not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model.value] = Encoders(*model.value)
    return _ENCODERS[model.value]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _linker(groups_of, model):
    """A row for each document: its counts, its groups' digest, and its distinct pairs with their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoders(model)
        text = Written(max(enc.n_a, enc.n_b))
        for b in batches:
            for g in groups_of(enc, b):
                doc, pair, many = links(g, enc.n_a, enc.n_b)
                n = len(g.rows)
                at = np.searchsorted(doc, np.arange(n + 1))
                total = np.zeros(n, np.int64)
                np.add.at(total, doc, many)
                a_at, b_at = (np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[g.at] for x in (g.na, g.nb))
                pair, many = pair.astype(_PAIR), many.astype(_PAIR)
                rows = pa.array(g.rows)
                packed = lambda x: pa.array([x[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("key").take(rows), b.column("id").take(rows), *(pa.array(x.astype(np.int64)) for x in (np.diff(a_at), np.diff(b_at), np.diff(g.at), total)),
                                                  pa.array(text.digests(g), pa.string()), packed(pair), packed(many)],
                                                 names=["key", "id", *_COUNTS, "groups_sha256", "pairs", "many"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of the documents that hold each pair."""
    held, size = [], 0
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merged() -> tuple[np.ndarray, np.ndarray]:
        k, c = np.unique(np.concatenate(held), return_counts=True)
        both, back = np.unique(np.concatenate((keys, k.astype(np.int64))), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, back, np.concatenate((counts, c)))
        return both, total

    def out() -> Iterator[pa.RecordBatch]:
        for k in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[k:k + (1 << 16)]), pa.array(counts[k:k + (1 << 16)])], names=["pair", "n"])

    for b in batches:
        for pairs in b.column("pairs"):
            held.append(np.frombuffer(pairs.as_py(), _PAIR))
            size += len(held[-1])
            if size >= SUMS:
                (keys, counts), held, size = merged(), [], 0
                if len(keys) >= SUMS:
                    yield from out()
                    keys = counts = np.zeros(0, np.int64)
    if held:
        keys, counts = merged()
    yield from out()


def _scorer(scores, n_b: int):
    """Sums over the links of frequent pairs, in a row for each document; ``pair`` is null in it.  Other pairs have a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_n, best = scores.value
        names = ["key", "n_best", "count_sum", "pair", "links"]
        for b in batches:
            pairs = [np.frombuffer(x.as_py(), _PAIR) for x in b.column("pairs")]
            n = len(pairs)
            doc = np.repeat(np.arange(n), [len(p) for p in pairs])
            pair = np.concatenate([*pairs, np.zeros(0, _PAIR)]).astype(np.int64)
            many = np.concatenate([*(np.frombuffer(x.as_py(), _PAIR) for x in b.column("many")), np.zeros(0, _PAIR)]).astype(np.int64)
            at = np.minimum(np.searchsorted(hot, pair), max(0, len(hot) - 1))
            known = hot[at] == pair if len(hot) else np.zeros(len(pair), bool)
            count = hot_n[at[known]] if len(hot) else np.zeros(0, np.int64)
            sums, tops = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(sums, doc[known], count * many[known])
            np.add.at(tops, doc[known], np.where(count == best[pair[known] // n_b], many[known], 0))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(tops), pa.array(sums), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            rest = np.flatnonzero(~known)
            for k in range(0, len(rest), 1 << 16):
                some = rest[k:k + (1 << 16)]
                void = pa.nulls(len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(doc[some])), void, void, pa.array(pair[some]), pa.array(many[some])], names=names)

    return run


def align(docs: DataFrame, a_json: str, b_model: bytes, text: str = "text", doc_id: str = "doc_id",
          fragment: int = FRAGMENT, hot: int = HOT) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for each document.

    ``a_json`` is the content of a tokenizer file of A, ``b_model`` that of B.
    ``n_best`` are the links whose pair is held by as many documents as the best pair of
    its A id; ``count_sum`` sums the pair's documents over the links.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.monotonically_increasing_id().alias("key"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > fragment, F.lit(False))
    model = spark.sparkContext.broadcast((a_json, b_model))
    enc = Encoders(a_json, b_model)
    if enc.n_a * enc.n_b >= 1 << 32:
        raise ValueError("the vocabularies have 2^32 pairs or more")
    # keys of the two parts are made by two jobs: told apart by their sign
    whole = _long_documents(own.where(is_long).withColumn("key", -1 - F.col("key")), model, kind, fragment)
    schema = f"key long, id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, pairs binary, many binary"
    short = own.where(~is_long).mapInArrow(_linker(_groups_of_texts, model), schema)
    linked = stored(short.unionByName(whole.mapInArrow(_linker(_groups_of_whole, model), schema)), "links")
    model.destroy()
    counts = stored(linked.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(F.col("n") * hot >= total).orderBy("pair").toArrow()  # at most ``hot`` rows by the condition
    top = counts.groupBy(F.expr(f"pair div {enc.n_b}").alias("a")).agg(F.max("n").alias("best"))  # at most A's vocabulary
    best = np.zeros(enc.n_a, np.int64)
    for r in top.toArrow().to_pylist():
        best[r["a"]] = r["best"]
    scores = spark.sparkContext.broadcast((frequent.column("pair").to_numpy(), frequent.column("n").to_numpy(), best))
    found = stored(linked.select("key", "pairs", "many").mapInArrow(_scorer(scores, enc.n_b), "key long, n_best long, count_sum long, pair long, links long"), "scores")
    scores.destroy()
    rest = (found.where("pair is not null").select("key", "pair", "links").join(counts.where(F.col("n") * hot < total), "pair")
            .withColumn("a", F.expr(f"pair div {enc.n_b}")).join(F.broadcast(top), "a")
            .select("key", F.when(F.col("n") == F.col("best"), F.col("links")).otherwise(0).alias("n_best"), (F.col("n") * F.col("links")).alias("count_sum")))
    sums = (found.where("pair is null").select("key", "n_best", "count_sum").unionByName(rest)
            .groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return linked.select("key", "id", *_COUNTS, "groups_sha256").join(sums, "key").select("id", *_COUNTS, "n_best", "count_sum", "groups_sha256")
