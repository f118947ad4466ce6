"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits: a bit is 1 if more than half of the text's shingle hashes
(XXH64 of three words, repeats included) have it.  Texts are linked if their
fingerprints differ in ``RADIUS`` bits or fewer; a class is what links reach.

Method: each bit position has a code, a non-zero vector of ``RADIUS`` + 1 bits, and
each non-zero vector v of that length a mask: the positions whose code has an odd
number of ones in common with v.  For any ``RADIUS`` positions some v is orthogonal to
their codes, so two fingerprints that differ only there agree under v's mask: of
2^(RADIUS+1) - 1 = 7 tables one at least has every linked pair in a bucket, by
construction and not by chance.  Masks have 36 or 37 bits, so chance meetings are rare.

Only distinct fingerprints, each with its smallest id, go to the tables: copies cost
nothing there.  Buckets of up to ``BUCKET`` fingerprints are verified pair by pair.
The fingerprints of fuller ones are linked exactly without pairs: two lie within
``RADIUS`` = 2 bits if and only if some value lies within one bit of both, so each
sends itself and its 64 neighbours, and at most 65 can meet at a value, where all are
linked with the smallest.  Classes come from ``graph.components``.

Scale: texts are scanned once and not shuffled.  A table row is two numbers, 7 for
each distinct fingerprint.  A full bucket is only counted, map-side, and joined by a
key that Spark can split; the same holds for a fingerprint that many documents share.

Defined results: a null, empty or blank text has fingerprint zero and is linked like
any other; a text of one or two words is one shingle.  Long texts are read in blocks
of ``BLOCK`` bytes.  Repeated rows and rows that share an id each get a row.  A row
without an id counts as a member of its class but gives no class its name; a class of
such rows only has none.  An empty table gives an empty result.  Other columns are
not read, so their names can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stored
from corpusmill.llm.graph import components

WORDS, SEED, BITS, RADIUS = 3, 42, 64, 2
#: Fingerprints in a bucket that are compared pair by pair.
BUCKET = 32
#: Bytes of a text whose words are held at once.
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(raw: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased, as lists of those in about ``block`` bytes."""
    at = 0
    while at < len(raw):
        gap = _SPACE.search(raw, at + block)
        end = gap.start() if gap else len(raw)
        yield raw[at:end].lower().split()
        at = end


def fingerprint(raw: bytes, block: int = BLOCK) -> int:
    """The SimHash of a text in UTF-8, unsigned."""
    from xxhash import xxh64_intdigest

    ones, n, carry = np.zeros(BITS, np.int64), 0, []
    for words in word_blocks(raw, block):
        words = carry + words
        hashes = [xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(WORDS)), strict=False)]
        if hashes:
            ones += np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(hashes)
        carry = words[-(WORDS - 1):]
    if not n and carry:
        return xxh64_intdigest(b" ".join(carry), SEED)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, print)`` for each row; ``print`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = np.fromiter((fingerprint(t.as_py() or b"") for t in b.column("text").cast(pa.binary())), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(made.view(np.int64))], names=["id", "print"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, print long")


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The covering masks: any ``radius`` positions are outside one of them."""
    full = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if (v & (i % full + 1)).bit_count() % 2) for v in range(1, full + 1)]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: pairs whose links give the classes of the distinct fingerprints ``print``.

    Every pair within ``RADIUS`` bits is linked, directly or by others that are.
    """
    tables = F.array(*(F.struct(F.lit(v).alias("table"), F.col("print").bitwiseAND(_signed(m)).alias("key")) for v, m in enumerate(masks())))
    keyed = nodes.select("print", F.inline(tables))
    # stored, so that both sides of the join are plain exchanges, which Spark can split
    sizes = stored(keyed.groupBy("table", "key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = stored(keyed.join(sizes, ["table", "key"]), "members")

    each = members.where(F.col("size") <= bucket).groupBy("table", "key").agg(F.sort_array(F.collect_list("print")).alias("prints"))
    near = lambda x: lambda y: (y > x) & (F.bit_count(x.bitwiseXOR(y)) <= RADIUS)
    pairs = F.flatten(F.transform("prints", lambda x: F.transform(F.filter("prints", near(x)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    few = each.select(F.inline(pairs)).distinct()

    full = members.where(F.col("size") > bucket).select("print").distinct()
    around = F.array(F.col("print"), *(F.col("print").bitwiseXOR(_signed(1 << i)) for i in range(BITS)))
    meet = full.select("print", F.explode(around).alias("value")).groupBy("value").agg(F.sort_array(F.collect_list("print")).alias("prints")).where("size(prints) > 1")
    many = meet.select(F.col("prints")[0].alias("a"), F.explode(F.expr("slice(prints, 2, size(prints) - 1)")).alias("b")).distinct()
    return few.unionByName(many)


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """``(id, print, component)`` for each row: its fingerprint and the smallest id of its class."""
    prints = stored(fingerprints(docs, text, doc_id), "prints")
    nodes = stored(prints.groupBy("print").agg(F.min("id").alias("low")), "nodes")
    found = components(links(nodes, bucket)).select(F.col("id").alias("print"), "label")
    labelled = stored(nodes.join(found, "print", "left").withColumn("label", F.coalesce("label", "print")), "labelled")
    lowest = stored(labelled.groupBy("label").agg(F.min("low").alias("component")), "lowest")
    classes = stored(labelled.join(lowest, "label").select("print", "component"), "classes")
    return prints.join(classes, "print").select("id", "print", "component")
