import random
import re
from itertools import combinations

import pytest
import xxhash

from corpusmill.llm import simhash as sh


def plain(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    s = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute(rows):
    """``rows``: (id, fingerprint)."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
            parent[root(i)] = root(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(i, low.get(root(k), i))
    return sorted(((i, f, low.get(root(k))) for k, (i, f) in enumerate(rows)), key=repr)


def test_any_two_positions_are_outside_a_mask():
    found = sh.masks()
    assert len(found) == 7 and all(36 <= m.bit_count() <= 37 for m in found)
    assert all(any(not m >> i & 1 and not m >> j & 1 for m in found) for i, j in combinations(range(64), 2))


@pytest.mark.parametrize("block", [5, 40, 1 << 20])
def test_fingerprints_of_texts(texts, block):
    for t in [*texts, "A b", "É é\x0bx\x85y", "a" * 100, " x"]:
        if t is None or len(t) < 20_000 or block > 5:
            assert sh.fingerprint((t or "").encode(), block) == plain(t)


def test_equals_brute_force(docs):
    rows = [(r.doc_id, plain(r.text)) for r in docs.collect()]
    got = sorted(((r.id, r.print % 2**64, r.component) for r in sh.simhash_components(docs).collect()), key=repr)
    assert got == brute(rows)


@pytest.mark.parametrize("bucket", [1, 4, 1000])
def test_links_of_clouds_of_fingerprints(spark, bucket):
    """Distances of 0 to 5 around some centres, in full buckets and others."""
    rng = random.Random(bucket)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            x = centre
            for _ in range(rng.choice((0, 1, 1, 2, 3, 4, 5))):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    rows = list(enumerate(prints))
    nodes = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in prints], "print long").repartition(3)
    of = {f - 2**64 if f >> 63 else f: i for i, f in rows}
    parent = {i: i for i in of.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in sh.links(nodes, bucket).collect():
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2
        a, b = sorted((root(of[r.a]), root(of[r.b])))
        parent[b] = a
    assert sorted((i, f, root(i)) for i, f in rows) == sorted(brute(rows))


def test_empty_table(empty):
    assert sh.simhash_components(empty).collect() == []
