"""Exact n-gram Jaccard self-join by universe partition and the pigeonhole principle.

A text's set holds the hashes of its distinct ``n``-word shingles (64 bits).  Sets
at or above a Jaccard similarity of t differ in at most (1-t)/(1+t) of their two
sizes together, say in H tokens.  Tokens are hashed into m segments, with m fixed
by a size band; if two sets differ in H tokens, at most H segments differ, so sets
with more than H non-empty segments share a whole segment's subset.  Hence:

* every set signs each non-empty segment's subset in its own band's scheme; a set
  so large that a partner may lie in the next band also signs there, where it
  needs only H + 1 segments plus the band's allowance (the larger partner signs all);
* linked sets share at least as many subsets as a set has non-empty segments beyond H,
  so a set with fewer shared ones has no link and is dropped;
* cost-based allocation: a set with more non-empty segments than H + 1 gives up its
  costliest ones - those with most sets, counted over the whole corpus - up to the
  band's allowance; the cheapest subset that two linked sets share always stays;
* a set with too few non-empty segments (mostly small ones) adds one-deletion
  neighbourhoods, where a segment with two or more tokens covers two differences;
  if even that is short of H + 1 (a freak of hashing), it signs each token.

Groups of one signature are not expanded into pairs.  Each is compared with one
hub, its member with most shared subsets - of many edited copies, the original.
Verified links are joined to components, and only groups that still span several
components compare members of different ones, where a pair can link at all: by the
sizes, by the triangle inequality of the Jaccard distance seen from the hub, by the
tokens that a set shares with any other member of open groups, which bound its
intersections, and by parity sketches, which bound the difference of a pair from
below.  Every link is verified on the full sets.

Scale: one reading of the texts gives sizes, digests and signatures (about 0.6 for
each shingle), and one shuffle deals these out, as a row for each part and some
hundred thousand signatures.  What several later steps use is a table first: the driver
plans, and keeps, each step's whole plan.  A subset that more than ``HOT`` of ``SIGNED`` texts
share is dealt out by text instead of meeting in one task; where it meets in one, its
sets are counted there.  Later steps count with map-side sums and join with skew
splitting.  Copies are one node, known by a 128-bit digest of the set; a task signs it
once.  Sets are recomputed for candidate nodes only, from the texts that have them:
keys and texts' hashes are broadcast if they are at most ``BROADCAST_KEYS``, else all
texts are read and joined.

Defined results: an empty table gives an empty one.  A null text and one without words have an empty set and link with
nothing; shorter texts than ``n`` words have their whole word sequence as one
shingle.  ``component`` is the smallest non-null id among linked documents (null if
all their ids are null).  Repeated rows are documents of their own with equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import textarrays as ta
from corpusmill.llm.common import lean, stored
from corpusmill.llm.graph import components

#: Texts that a task signs at once.
SIGNED = 2000
#: Of these, those that may share a signature before it is dealt out by text.
HOT = 64
#: Keys of candidate sets that are broadcast at most (64 MB with their texts' hashes).
BROADCAST_KEYS = 4_000_000
#: A signature's tag: how many may be given up, how many must be shared, the scheme, and two marks.
_SPARE, _NEED, _NEXT, _HOT, _MARK = (1 << 11) - 1, (1 << 13) - 1, 1 << 24, 1 << 30, 1 << 29

#: Bits of a sketch: for sets of up to about this many tokens they tell near pairs from others.
SKETCH_BITS = 1024
#: Members of a group that are compared with as many others at once, on average.
BLOCK = 256
_u = np.uint64


@dataclass(frozen=True)
class Rule:
    """Sets link when ``100 * intersection >= percent * union``."""

    n: int = 5
    percent: int = 75

    def differ(self, a: int, b: int) -> int:
        """Tokens in which linked sets of these sizes differ at most."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def largest_partner(self, size: int) -> int:
        return 100 * size // self.percent

    def band(self, size: int) -> int:
        return size.bit_length() - 1

    def segments(self, band: int) -> int:
        top = 2 << band
        share = 2 * (100 - self.percent) / (100 + self.percent)
        return int(np.ceil(1.26 * share * top + np.sqrt(top)))

    def allowance(self, band: int) -> int:
        return 2 + (2 << band) // 20


def shingle_sets(arr: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` for every text with words."""
    for c in ta.chunks(arr, ta.NON_SPACE, True):
        words = c.word_hashes()
        grams = ta.window_hashes(words, n)
        for r in np.flatnonzero(c.n_words).tolist():
            a, b = int(c.word_at[r]), int(c.word_at[r + 1])
            if b - a >= n:
                s = np.sort(grams[a:b - n + 1])
                fresh = np.ones(len(s), dtype=bool)
                np.not_equal(s[1:], s[:-1], out=fresh[1:])
                yield c.row0 + r, s[fresh]
            else:  # the whole sequence, told apart from shingles by its length
                yield c.row0 + r, ta.window_hashes(words[a:b], b - a) + _u(b - a)


def digest(s: np.ndarray) -> bytes:
    return blake2b(s.tobytes(), digest_size=16).digest()


def _key(d: bytes) -> int:
    return int.from_bytes(d[:8], "little", signed=True)


@lru_cache(maxsize=256)
def _segments(rule: Rule, band: int) -> tuple[np.uint64, np.ndarray]:
    """What deals a band's tokens out to segments, and a hash for each segment."""
    salt = _u(band * 0x632BE59BD9B4E019 + 1 & (1 << 64) - 1)
    places = ta.mix(np.arange(rule.segments(band), dtype=np.uint64) * _u(0xD1342543DE82EF95) + salt)
    return ta.mix(np.array([salt]))[0] | _u(1), places


def signatures(s: np.ndarray, rule: Rule) -> list[tuple[np.ndarray, int]]:
    """``(signatures, tag)`` of a set, by scheme."""
    size, out = len(s), []
    own, most = rule.band(size), rule.largest_partner(size)
    for band in (own, own + 1):
        if band > own and most < (2 << own):
            break
        bound = rule.differ(size, min(most, (2 << band) - 1))
        if bound == 0:
            continue  # linked sets of this size are equal, and equal sets are one node
        spread, places = _segments(rule, band)
        m = len(places)
        seg = ((s * spread >> _u(32)) * _u(m) >> _u(32)).view(np.int64)  # tokens are hashes already
        counts, total = np.bincount(seg, minlength=m), np.zeros(m, dtype=np.uint64)
        np.add.at(total, seg, s)
        used = np.flatnonzero(counts)
        sums, place = total[used], places[used]
        exact = ta.mix(sums ^ place)
        spare = len(used) - bound - 1
        if spare >= 0:
            spare = min(spare, rule.allowance(band), _SPARE)
            if band > own:
                exact = np.sort(exact)[:bound + 1 + spare]
            # a smaller partner signs only as many in this scheme as to share one more than the allowance
            need = min(len(exact) - bound, rule.allowance(band) + 1, _NEED)
            out.append((exact, spare | need << 11 | (_NEXT if band > own else 0)))
            continue
        count, tokens = counts[used], s[np.argsort(seg, kind="stable")]
        near = ta.mix(sums + place)  # one-deletion neighbourhoods
        wide = np.repeat(count > 1, count)
        less = ta.mix((np.repeat(sums, count) - tokens)[wide] + np.repeat(place, count)[wide])
        tag = 1 << 11 | (_NEXT if band > own else 0)
        out.append((np.unique(np.concatenate((exact, near, less))), tag))
        if (count == 1).sum() + 2 * (count > 1).sum() <= bound:
            out.append((ta.mix(tokens ^ _u(0xA0761D6478BD642F)), tag))
    return out


def _regrouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``rows``, whatever size they have."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        for k in range(0, b.num_rows, rows):
            held.append(b.slice(k, rows))
            if sum(x.num_rows for x in held) >= rows:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


def _signed(batches: Iterator[pa.RecordBatch], rule: Rule, hot: int) -> Iterator[pa.RecordBatch]:
    """``(sig, node, tag)`` of every set of a task; of what ``SIGNED`` texts need, little more than the signatures is held."""
    seen: set[int] = set()
    for piece in _regrouped(batches, SIGNED):
        yield from _sign(piece.column("text"), rule, hot, seen, [])


def _sign(text: pa.Array, rule: Rule, hot: int, seen: set[int], members: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """``(sig, node, tag)`` of the sets of these texts that are not yet ``seen``, in the order of
    the signatures; ``members`` gets ``(row, size, digest)`` of every text with words."""
    sigs, keys, tags, sizes = [], [], [], []
    for row, s in shingle_sets(text, rule.n):
        members.append((row, len(s), name := digest(s)))
        if len(s) < 2 or (key := _key(name)) in seen:
            continue
        seen.add(key)
        for x, tag in signatures(s, rule):
            sigs.append(x)
            keys.append(key)
            tags.append(tag)
            sizes.append(len(x))
    del text
    if not sigs:
        return
    sig, own = np.concatenate(sigs).view(np.int64), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    del sigs
    order = np.argsort(sig)
    sig, own = sig[order], own[order]
    del order
    first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    often = np.diff(np.concatenate((first, [len(sig)]))) > hot
    mark = first[often]
    last = np.concatenate((first[1:], [len(sig)]))[often]
    del first, often
    large = np.zeros(len(sig), dtype=bool)
    for i, j in zip(mark.tolist(), last.tolist(), strict=True):
        large[i:j] = True
    node, kind = np.array(keys, dtype=np.int64), np.array(tags, dtype=np.int32)
    for k in range(0, len(sig), 200_000):
        at = own[k:k + 200_000]
        tag = np.where(large[k:k + 200_000], kind[at] | _HOT, kind[at]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(sig[k:k + 200_000]), pa.array(node[at]), pa.array(tag)], names=["sig", "node", "tag"])
    if len(mark):
        yield pa.RecordBatch.from_arrays([pa.array(sig[mark]), pa.array(node[own[mark]]), pa.array(np.full(len(mark), _MARK, dtype=np.int32))],
                                         names=["sig", "node", "tag"])
    del sig, own, large  # else they stay while the next texts are signed


def _member_batch(of: pa.Array, names: pa.Array, members: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """``(id, size, digest, node, of)`` of all rows; an empty set has no digest and no node."""
    size, name, node = [0] * len(names), [None] * len(names), [None] * len(names)
    for row, n, d in members:
        size[row], name[row], node[row] = n, d, _key(d)
    return pa.RecordBatch.from_arrays([names, pa.array(size, pa.int64()), pa.array(name, pa.binary()), pa.array(node, pa.int64()), of],
                                      names=["id", "size", "digest", "node", "of"])


def _blocks(b: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """``(part, sigs, nodes, tags)``: a batch of signatures as one row for each part that they are dealt to.

    A signature's part follows from it alone, but members of large groups are dealt out by node too."""
    sig, node, tag = (b.column(k).to_numpy() for k in range(3))
    share = (sig.view(np.uint64) ^ _u(1 << 63)) >> _u(32)  # the batch has the order of the signatures, and so of the parts
    dealt = (tag & _HOT) != 0
    if dealt.any():
        share[dealt] = ta.mix(sig[dealt].view(np.uint64) ^ ta.mix(node[dealt].view(np.uint64))) >> _u(32)
        order = np.argsort(share, kind="stable")
        sig, node, tag, share = sig[order], node[order], tag[order], share[order]
    part = (share * _u(parts) >> _u(32)).astype(np.int32)
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    at = np.append(first, len(part)).astype(np.int32)
    packed = [pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at * v.itemsize), pa.py_buffer(np.ascontiguousarray(v))])
              for v in (sig, node, tag)]
    return pa.RecordBatch.from_arrays([pa.array(part[first]), *packed], names=["part", "sigs", "nodes", "tags"])


def _in_batches(sig: np.ndarray, node: np.ndarray, tag: np.ndarray, cost: np.ndarray, keep: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The kept rows, 200,000 looked at at once."""
    for k in range(0, len(sig), 200_000):
        at, own = slice(k, k + 200_000), keep[k:k + 200_000]
        yield pa.RecordBatch.from_arrays([pa.array(sig[at][own]), pa.array(node[at][own]), pa.array(tag[at][own].astype(np.int32)),
                                          pa.array(cost[at][own].astype(np.int32))], names=["sig", "node", "tag", "cost"])


def _shared(sig: np.ndarray, node: np.ndarray, tag: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(sig, node, tag, cost)`` of a part's signatures that two or more sets have."""
    dealt = (tag & _HOT) != 0  # part of a large group, whose other members may be elsewhere
    many = int(dealt.sum())
    if many:
        yield from _in_batches(sig[dealt], node[dealt], tag[dealt] & ~_HOT, np.zeros(many, dtype=np.int32), np.ones(many, dtype=bool))
        sig, node, tag = sig[~dealt], node[~dealt], tag[~dealt]
    del dealt
    order = np.argsort(sig)
    sig = sig[order]
    same = np.zeros(len(sig) + 1, dtype=bool)
    np.equal(sig[1:], sig[:-1], out=same[1:-1])
    same = same[1:] | same[:-1]  # most signatures come once, and go no further
    sig, order = sig[same], order[same]
    node, tag = node[order], tag[order]
    del same
    if not len(sig):
        return
    order = np.lexsort((node, sig))
    sig, node, tag = sig[order], node[order], tag[order]
    del order
    mark = (tag & _MARK) != 0
    start = np.concatenate(([True], sig[1:] != sig[:-1]))
    group = np.cumsum(start, dtype=np.int32) - 1
    own = ~mark
    # a set comes once from each task that has its text; a mark comes before or after a set's own row
    last = np.flatnonzero(own)
    again = ~start[last[1:]] & (group[last[1:]] == group[last[:-1]]) & (node[last[1:]] == node[last[:-1]])
    own[last[1:][again]] = False
    del start, last, again
    cost = np.bincount(group[own], minlength=group[-1] + 1).astype(np.int32)
    whole = cost > 1
    cost[group[mark]] = 0
    whole[group[mark]] = True
    yield from _in_batches(sig, node, tag, cost[group], own & whole[group])


def _read_once(docs: DataFrame, rule: Rule, hot: int) -> DataFrame:
    """Both of what a reading of all texts gives, told apart by ``sig``, from ``(id, text, of)``:

    ``(id, size, digest, node, of)`` of every document; the digest and node of an empty set are null.
    ``(sig, node, tag, cost)`` for every signature that two or more sets have; ``cost`` is
    their number, or 0 where members of a large group are elsewhere too.
    """
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a task holds its share in memory
    kind = docs.schema["id"].dataType.simpleString()
    member = ["id", "size", "digest", "node", "of"]

    def filled(have: pa.RecordBatch, like: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([have.column(f.name) if f.name in have.schema.names else pa.nulls(have.num_rows, f.type) for f in like], schema=like)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for piece in _regrouped(batches, SIGNED):
            like = pa.schema([("part", pa.int32()), ("sigs", pa.binary()), ("nodes", pa.binary()), ("tags", pa.binary()), ("id", piece.schema.field("id").type),
                              ("size", pa.int64()), ("digest", pa.binary()), ("node", pa.int64()), ("of", pa.int64())])
            members: list[tuple[int, int, bytes]] = []
            for b in _sign(piece.column("text"), rule, hot, seen, members):
                yield filled(_blocks(b, parts), like)
            own = _member_batch(piece.column("of"), piece.column("id"), members)
            yield filled(own.append_column("part", pa.array(np.arange(own.num_rows, dtype=np.int32) % parts, pa.int32())), like)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        like = None
        for b in batches:
            like = pa.schema([("id", b.schema.field("id").type), ("size", pa.int64()), ("digest", pa.binary()), ("node", pa.int64()), ("of", pa.int64()),
                              ("sig", pa.int64()), ("tag", pa.int32()), ("cost", pa.int32())])
            yield filled(b.select(member).filter(b.column("size").is_valid()), like)
            held.append([ta.string_parts(b.column(k))[1].view(t) for k, t in (("sigs", np.int64), ("nodes", np.int64), ("tags", np.int32))])
        if held:
            sig, node, tag = (np.concatenate([x[k] for x in held]) for k in range(3))
            held.clear()
            for b in _shared(sig, node, tag):
                yield filled(b, like)

    signed = docs.select("id", "text", "of").mapInArrow(
        lean(sign), f"part int, sigs binary, nodes binary, tags binary, id {kind}, size long, digest binary, node long, of long")
    return stored(signed.repartitionById(parts, "part").mapInArrow(
        lean(share), f"id {kind}, size long, digest binary, node long, of long, sig long, tag int, cost int"), "setjoin-read")


def _allocated(shared: DataFrame) -> DataFrame:
    """``(sig, node, have)``: the signatures through which a set may have a link, without
    those that it gives up as too costly; ``have`` is its number of shared ones."""
    parted = shared.where("cost = 0").groupBy("sig", "node").agg(F.min("tag").alias("tag"))
    cost = parted.groupBy("sig").agg(F.count("*").cast("int").alias("cost"))
    rows = shared.where("cost > 1").select("sig", "node", "tag", "cost").unionByName(parted.join(cost, "sig").where("cost > 1"))
    # a node's rows are bounded by its own size; the total order is the same for all nodes
    own = Window.partitionBy("node", "tag")
    place = F.row_number().over(own.orderBy(F.desc("cost"), "sig"))
    kept = (rows.withColumns({"place": place, "have": F.count("*").over(own).cast("int")})
            .where((F.col("place") > F.col("tag").bitwiseAND(F.lit(_SPARE)))
                   & (F.col("have") >= F.shiftright("tag", 11).bitwiseAND(F.lit(_NEED)))).select("sig", "node", "have"))
    return stored(kept, "setjoin-kept")


def _sets(docs: DataFrame, rule: Rule, wanted: DataFrame, broadcast_keys: int) -> DataFrame:
    """``(node, digest, set, sketch)`` of the wanted nodes, each digest once; ``docs`` has ``(text, of)``
    and ``wanted`` ``(node, of)``, the ``of`` of one text for each of a node's sets."""
    # a table of few files: taking it straight from the join would be a job for each shuffle partition
    spark, wanted = docs.sparkSession, stored(wanted, "setjoin-wanted")
    few = wanted.count() <= broadcast_keys
    known = np.fromiter((x for r in wanted.toLocalIterator() for x in (r.node, r.of)), dtype=np.int64).reshape(-1, 2) if few else None
    keys = spark.sparkContext.broadcast((np.unique(known[:, 0]), np.unique(known[:, 1]))) if few else None

    def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, values)
        return np.append(known, 0)[at] == values if len(known) else np.zeros(len(values), dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, texts = keys.value if keys is not None else (None, None)
        seen: set[bytes] = set()
        for b in batches:
            if texts is not None:  # texts that no wanted set needs are not read at all
                b = b.filter(pa.array(among(b.column("of").to_numpy(), texts)))
            names, sets = [], []
            for _, s in shingle_sets(b.column("text"), rule.n):
                d = digest(s)
                if d in seen or nodes is not None and not among(np.array([_key(d)]), nodes)[0]:
                    continue
                seen.add(d)
                names.append(d)
                sets.append(s.tobytes())
                if len(names) >= 500:
                    yield _set_batch(names, sets)
                    names, sets = [], []
            if names:
                yield _set_batch(names, sets)

    found = docs.select("text", "of").mapInArrow(lean(run), "node long, digest binary, set binary, sketch array<long>")
    if not few:
        found = found.join(wanted, "node", "left_semi")
    # equal digests have equal sets: keep any one
    return stored(found.dropDuplicates(["digest"]), "setjoin-sets")


def sketch(s: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """A bit for each hash bucket: whether an odd number of tokens falls there.

    Two sketches differ in at most as many bits as their sets do in tokens.
    """
    place = (ta.mix(s ^ _u(0x2545F4914F6CDD1D)) >> _u(64 - bits.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(bool)).view(np.int64)


def _set_batch(names: list[bytes], sets: list[bytes]) -> pa.RecordBatch:
    sketches = [sketch(np.frombuffer(s, dtype=np.uint64)) for s in sets]
    return pa.RecordBatch.from_arrays([pa.array([_key(d) for d in names], pa.int64()), pa.array(names, pa.binary()), pa.array(sets, pa.binary()),
                                       pa.array(sketches, pa.list_(pa.int64()))], names=["node", "digest", "set", "sketch"])


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``(a, b, a_digest, b_digest, shared, total)`` for each pair of nodes, from their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared, total = [], []
            for x, y in zip(b.column("a_set"), b.column("b_set"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                common = int((long[at] == short).sum())
                shared.append(common)
                total.append(len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("a", "b", "a_digest", "b_digest")),
                                              pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                                             names=["a", "b", "a_digest", "b_digest", "shared", "total"])

    one = lambda x: sets.select(F.col("node").alias(x), F.col("digest").alias(f"{x}_digest"), F.col("set").alias(f"{x}_set"))
    # sizes first: pairs that can't link carry no sets
    size = sets.select("node", (F.length("set") / 8).cast("long").alias("size"))
    sized = (pairs.join(size.withColumnsRenamed({"node": "a", "size": "a_size"}), "a")
             .join(size.withColumnsRenamed({"node": "b", "size": "b_size"}), "b"))
    fit = 100 * F.least("a_size", "b_size") >= rule.percent * F.greatest("a_size", "b_size")
    joined = sized.where(fit).select("a", "b").distinct().join(one("b"), "b").join(one("a"), "a")
    return joined.select("a", "b", "a_digest", "b_digest", "a_set", "b_set").mapInArrow(
        lean(run), "a long, b long, a_digest binary, b_digest binary, shared long, total long")


def _common_tokens(sets: DataFrame) -> DataFrame:
    """``(node, size, common)``: of each set, its size and its tokens that another of the sets has.

    No intersection with another of these sets is larger than ``common``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, s in zip(b.column("node"), b.column("set"), strict=True):
                tokens = np.frombuffer(s.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), node.as_py(), dtype=np.int64)), pa.array(tokens)],
                                                 names=["node", "token"])

    tokens = sets.select("node", "set").mapInArrow(lean(run), "node long, token long")
    often = tokens.groupBy("token").agg(F.count("*").alias("n")).withColumn("shared", (F.col("n") > 1).cast("int")).select("token", "shared")
    return tokens.join(often, "token").groupBy("node").agg(F.count("*").alias("size"), F.sum("shared").alias("common"))


def _possible(left: DataFrame, rule: Rule) -> DataFrame:
    """``(a, b)`` with a < b: members of one group and of different components that may link.

    Members are packed into blocks of about ``BLOCK``; a group's blocks are joined, and
    two blocks are compared at once.  Those of a group's largest component meet members
    of other components only, so a large family and its few outsiders cost little.
    """
    parts = left.groupBy("sig", "label").agg(F.count("*").alias("n"))
    groups = (parts.groupBy("sig").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels"))
              .where("labels > 1").drop("labels"))
    member = F.struct("node", "label", "far", "size", "common", "sketch")
    rows = left.join(groups, "sig").withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / F.lit(float(BLOCK)))))
    every = rows.groupBy("sig", "block").agg(F.collect_list(member).alias("y")).drop("block")
    other = rows.where("label <> main").groupBy("sig", "block").agg(F.collect_list(member).alias("x")).drop("block")
    limit = 1 - rule.percent / 100 + 1e-9

    def columns(values: pa.Array) -> dict[str, np.ndarray]:
        out = {k: values.field(k).to_numpy(zero_copy_only=False) for k in ("node", "label", "far", "size", "common")}
        lines = values.field("sketch")
        known = lines.is_valid().to_numpy(zero_copy_only=False)
        out["sketch"] = np.zeros((len(lines), SKETCH_BITS // 64), dtype=np.uint64)
        out["sketch"][known] = lines.drop_null().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, SKETCH_BITS // 64)
        out["known"] = known
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs: set[tuple[int, int]] = set()
            for one, two in zip(b.column("x"), b.column("y"), strict=True):
                x, y = columns(one.values), columns(two.values)
                sizes = x["size"][:, None] + y["size"]
                fit = ((x["label"][:, None] != y["label"])
                       & ((100 + rule.percent) * np.minimum(x["common"][:, None], y["common"]) >= rule.percent * sizes)
                       & ~(np.abs(x["far"][:, None].astype(float) - y["far"].astype(float)) > limit))
                i, j = np.nonzero(fit)
                apart = np.bitwise_count(x["sketch"][i] ^ y["sketch"][j]).sum(axis=1, dtype=np.int64)
                near = ((100 + rule.percent) * apart <= (100 - rule.percent) * sizes[i, j]) | ~x["known"][i] | ~y["known"][j]
                i, j = x["node"][i[near]], y["node"][j[near]]
                pairs.update(zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return other.join(every, "sig").select("x", "y").mapInArrow(lean(run), "a long, b long").distinct()


def _links(checked: DataFrame, rule: Rule) -> DataFrame:
    return checked.where(100 * F.col("shared") >= rule.percent * F.col("total"))


def _with_of(docs: DataFrame) -> DataFrame:
    """With ``of``, a hash of the text that Spark makes without cutting it into words."""
    return docs.withColumn("of", F.xxhash64("text"))


def link_nodes(docs: DataFrame, rule: Rule = Rule(), hot: int = HOT, broadcast_keys: int = BROADCAST_KEYS,  # noqa: B008
               read: DataFrame | None = None) -> DataFrame | None:
    """``(a_digest, b_digest)`` links whose components are those of all links; ``docs`` has a
    ``text``, and ``read`` is what ``_read_once`` gave for it, if that is there already."""
    docs = _with_of(docs)
    if read is None:
        read = _read_once(docs.withColumn("id", F.lit(None).cast("long")), rule, hot)
    kept = _allocated(read.where("sig IS NOT NULL"))
    most = F.max(F.struct("have", "node"))["node"]
    hubs = kept.groupBy("sig").agg(most.alias("hub"), F.count("*").alias("many")).where("many > 1").drop("many")
    groups = stored(kept.join(hubs, "sig"), "setjoin-groups")
    texts = read.where("sig IS NULL AND digest IS NOT NULL").groupBy("digest").agg(F.any_value("node").alias("node"), F.min("of").alias("of"))
    sets = _sets(docs, rule, texts.join(groups.select("node").distinct(), "node").select("node", "of"), broadcast_keys)
    stars = groups.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    checked = stored(_verified(stars, sets, rule), "setjoin-checked")
    first = _links(checked, rule).select("a", "b", "a_digest", "b_digest")

    # groups in one component are done; in the others, members of different components remain
    label = components(first.select("a", "b"))
    named = stored(groups.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node")), "setjoin-named")
    # a member's distance from the hub; unseen pairs (sizes that can't link) have none
    distance = checked.select(F.col("a").alias("hub"), F.col("b").alias("node"), (1 - F.col("shared") / F.col("total")).alias("far"))
    open_sigs = named.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("sig")
    left = stored(named.join(open_sigs, "sig").join(distance, ["hub", "node"], "left"), "setjoin-open")
    bound = _common_tokens(sets.join(left.select("node").distinct(), "node", "left_semi"))
    fit = (100 + rule.percent) * F.col("common") >= rule.percent * (F.col("size") + F.ceil(F.col("size") * rule.percent / 100))
    # a key of several digests (a freak) has no sketch: nothing is ruled out for it
    lines = sets.groupBy("node").agg(F.when(F.count("*") == 1, F.any_value("sketch")).alias("sketch"))
    left = (left.where("node <> hub").join(bound.where(fit), "node").join(lines, "node")
            .select("sig", "node", "label", "far", "size", "common", "sketch"))
    rest = _possible(stored(left, "setjoin-rest"), rule)
    done = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(rest.join(done, ["a", "b"], "left_anti"), "setjoin-pairs")
    second = _links(_verified(rest, sets, rule), rule).select("a", "b", "a_digest", "b_digest")
    return stored(reduce(DataFrame.unionByName, (first, second)).select("a_digest", "b_digest").distinct(), "setjoin-links")


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = Rule(),  # noqa: B008
                       hot: int = HOT, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``(id, size, digest, component)`` for each document: its set's size and digest,
    and the smallest id that links reach."""
    plain = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    read = _read_once(_with_of(plain), rule, hot)
    members = read.where("sig IS NULL").select("id", "size", "digest")
    links = link_nodes(plain, rule, hot, broadcast_keys, read)
    nodes = members.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("id").alias("first"))
    label = components(links.select(F.col("a_digest").alias("a"), F.col("b_digest").alias("b")))
    linked = stored(label.join(nodes, label["id"] == nodes["digest"]).select("digest", "label", "first"), "setjoin-linked")
    lowest = linked.groupBy("label").agg(F.min("first").alias("lowest"))
    of_linked = linked.join(lowest, "label").select("digest", "lowest")
    # copies of one text may be a third of all rows; the other side has one row each, so the join can be split
    named = nodes.join(of_linked, "digest", "left").select("digest", F.coalesce("lowest", "first").alias("component"))
    return members.join(named, "digest", "left").select(
        "id", "size", "digest", F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))
