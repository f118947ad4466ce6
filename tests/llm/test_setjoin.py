import random
import re

import numpy as np
import pytest

from corpusmill.llm import setjoin
from corpusmill.llm.graph import components


def shingles(t, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m.group(0).lower(), t or ""))
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(i, low.get(root(k), i))
    return [(i, len(s), low.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def found(df, **kw):
    return sorted(((r.id, r.size, r.component) for r in setjoin.jaccard_components(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("kw", [{}, {"hot": 1}, {"broadcast_keys": 0}])
def test_equals_brute_force(docs, kw):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, **kw) == sorted(brute(rows), key=repr)


def test_families_around_a_base_at_every_size(spark):
    """Copies whose similarity to their base, and to each other, lies on both sides of the limit."""
    rng, rows = random.Random(11), []
    passage = " ".join(f"p{k}" for k in range(25))
    for length in (5, 6, 7, 8, 9, 11, 13, 16, 20, 27, 40, 70, 130, 260):
        base = [f"b{length}_{k}" for k in range(length)]
        rows.append(" ".join(base))
        for edits in (1, 1, 2, 2, 3, 4, 6):
            v = list(base)
            for _ in range(min(edits, length)):
                k = rng.randrange(len(v))
                v[k:k + 1] = rng.choice(([f"e{rng.random()}"], [], [v[k], f"e{rng.random()}"]))
            rows.append(" ".join(v))
        rows.append(" ".join(base[: int(length * 0.8)]))
        rows += [passage + " " + " ".join(f"q{rng.random()}" for _ in range(length))] * 1
    rng.shuffle(rows)
    table = list(enumerate(rows))
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    want = sorted(brute(table), key=repr)
    assert found(df) == want and found(df, hot=2) == want
    assert len({c for _, _, c in want}) < len(want)


def test_signatures_meet_for_every_linked_pair():
    """The pigeonhole bound itself, without the engine: any linked pair shares an emitted signature, and as many as it must."""
    rule, rng = setjoin.Rule(), np.random.default_rng(5)
    for _ in range(3000):
        size = int(rng.integers(2, 40)) if rng.random() < 0.7 else int(rng.integers(40, 400))
        a = np.unique(rng.integers(1, 1 << 62, size, dtype=np.uint64))
        keep = a[rng.random(len(a)) > rng.choice((0.03, 0.1, 0.14))]
        b = np.unique(np.concatenate((keep, rng.integers(1, 1 << 62, int(rng.integers(0, 1 + len(a) // 6)), dtype=np.uint64))))
        common = len(np.intersect1d(a, b))
        if not len(b) or 100 * common < 75 * (len(a) + len(b) - common) or np.array_equal(a, b):
            continue
        of = [{int(s): tag for sigs, tag in setjoin.signatures(x, rule) for s in sigs} for x in (a, b)]
        shared = of[0].keys() & of[1].keys()
        assert shared, (a, b)
        # in some scheme that both sign, each shares as many as its tag says, and a cheapest one is never given up
        sound = False
        for one in {t for s in shared for t in [(of[0][s], of[1][s])]}:
            own = [s for s in shared if (of[0][s], of[1][s]) == one]
            sound |= all(len(own) >= max(1, t >> 11 & setjoin._NEED) and len(own) > (t & setjoin._SPARE) for t in one)
        assert sound


def test_sets_too_small_for_segments_sign_their_tokens():
    class Crowded(setjoin.Rule):
        def segments(self, band):
            return 2

    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(1, 1 << 62, 60, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:-4], rng.integers(1, 1 << 62, 3, dtype=np.uint64))))
    one, two = ({int(s) for sigs, _ in setjoin.signatures(x, Crowded()) for s in sigs} for x in (a, b))
    assert one & two


def test_empty_and_wordless(spark, empty):
    assert found(empty) == []
    df = spark.createDataFrame([(3, None), (1, ""), (None, " \n"), (2, "a"), (4, "A")], "doc_id long, text string")
    assert found(df) == sorted([(3, 0, 3), (1, 0, 1), (None, 0, None), (2, 1, 2), (4, 1, 2)], key=repr)


def test_components_of_paths_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, **{k: 200 for k in range(200, 203)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signing_holds_little_more_than_the_signatures():
    import tracemalloc

    import pyarrow as pa

    from corpusmill.llm import setjoin

    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(50_000)}" for _ in range(200)) for _ in range(setjoin.SIGNED)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]
    rule = setjoin.Rule()
    list(setjoin._signed(batches, rule, setjoin.HOT))  # what is kept for good, as the powers, is made
    rows = sum(len(x) for _, s in setjoin.shingle_sets(batches[0].column("text"), rule.n) for x, _ in setjoin.signatures(s, rule))
    tracemalloc.start()
    got = 0
    for b in setjoin._signed(batches, rule, setjoin.HOT):
        got += b.num_rows
        del b
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print(most / rows)
    assert got == rows and most < 60 * rows


def test_signatures_are_dealt_out_in_blocks_not_row_by_row():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    sig = np.sort(rng.integers(-(1 << 62), 1 << 62, 5000) * 2)
    sig[100:400] = sig[100]  # one that many sets have: its members are dealt out by node
    node = rng.integers(-(1 << 62), 1 << 62, 5000)
    tag = np.full(5000, 7, dtype=np.int32)
    tag[100:400] |= setjoin._HOT
    b = setjoin._blocks(pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node), pa.array(tag)], names=["sig", "node", "tag"]), 16)
    assert b.num_rows <= 16 and len(set(b.column("part").to_pylist())) == b.num_rows and set(b.column("part").to_pylist()) <= set(range(16))
    rows, part_of = [], {}
    for part, s, n, t in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
        s, n, t = np.frombuffer(s, np.int64).tolist(), np.frombuffer(n, np.int64).tolist(), np.frombuffer(t, np.int32).tolist()
        rows += zip(s, n, t, strict=True)
        for x in zip(s, n, t, strict=True):
            part_of.setdefault(x[0], set()).add(part)
    assert sorted(rows) == sorted(zip(sig.tolist(), node.tolist(), tag.tolist(), strict=True))
    assert all(len(p) == 1 for s, p in part_of.items() if s != sig[100]) and len(part_of[int(sig[100])]) > 8


def test_shared_signatures_carry_their_number_of_sets():
    """Sets of a signature are counted where they meet; parts of large groups, which may be elsewhere too, are left to count."""
    mark, hot = setjoin._MARK, setjoin._HOT
    rows = [(1, 10, 5), (1, 11, 5), (1, 11, 5), (1, 12, 5),  # three sets, one signed by two tasks
            (2, 10, 5),                                      # one set
            (3, 10, 5), (3, 10, 5),                          # one set, signed by two tasks
            (4, 10, 5), (4, 13, mark),                       # the others of a large group are elsewhere
            (5, 10, 5 | hot), (5, 14, mark)]                 # dealt out by node
    rng = random.Random(1)
    for _ in range(20):
        rng.shuffle(rows)
        sig, node, tag = (np.array(x, dtype=t) for x, t in zip(zip(*rows, strict=True), (np.int64, np.int64, np.int32), strict=True))
        got = [tuple(r.values()) for b in setjoin._shared(sig, node, tag) for r in b.to_pylist()]
        assert sorted(got) == [(1, 10, 5, 3), (1, 11, 5, 3), (1, 12, 5, 3), (4, 10, 5, 0), (5, 10, 5, 0)]


def test_one_reading_gives_members_and_signatures(spark, docs):
    """What needed two readings of all texts comes from one, and sets are made again from candidates' texts only."""
    plain = docs.selectExpr("doc_id AS id", "text", "xxhash64(text) AS of")
    rows = setjoin._read_once(plain, setjoin.Rule(), setjoin.HOT)
    members = rows.where("sig IS NULL").collect()
    texts = [(r.id, r.text) for r in plain.collect()]
    assert sorted(((r.id, r.size) for r in members), key=repr) == sorted(((i, len(shingles(t))) for i, t in texts), key=repr)
    assert len({r.digest for r in members if r.digest}) == len({frozenset(shingles(t)) for _, t in texts if shingles(t)})
    costs = {}
    for r in rows.where("sig IS NOT NULL AND cost > 0").collect():
        costs.setdefault(r.sig, []).append((r.node, r.cost))
    assert costs and all(len({n for n, _ in v}) == len(v) and {c for _, c in v} == {len(v)} for v in costs.values())

    one = next(r for r in members if r.size > 20)
    wanted = spark.createDataFrame([(one.node, one.of)], "node long, of long")
    for most in (setjoin.BROADCAST_KEYS, 0):
        assert [r.digest for r in setjoin._sets(plain, setjoin.Rule(), wanted, most).collect()] == [one.digest]
    # of a text with another hash nothing is read, whatever set it has
    other = spark.createDataFrame([(one.node, one.of ^ 1)], "node long, of long")
    assert setjoin._sets(plain, setjoin.Rule(), other, setjoin.BROADCAST_KEYS).count() == 0


def started(spark, run):
    """The Spark jobs that ``run`` starts."""
    sc, group = spark.sparkContext, f"count-{random.random()}"
    sc.setJobGroup(group, "")
    try:
        run()
        return sc.statusTracker().getJobIdsForGroup(group)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_candidates_do_not_cost_a_job_for_each_partition(spark, docs):
    wanted = spark.range(40).selectExpr("id AS node", "id AS of").repartition(40)
    held = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "64k")
    try:
        jobs = started(spark, lambda: setjoin._sets(setjoin._with_of(docs), setjoin.Rule(), wanted, 100).count())
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", held)
    assert len(jobs) < 20


def test_a_round_of_components_plans_its_links_once(spark, monkeypatch):
    from corpusmill.llm import graph

    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return stored(df, name)

    stored = graph.stored
    monkeypatch.setattr(graph, "stored", noted)
    links = [(k, k + 1) for k in range(30)] + [(50, 51), (51, 50), (7, 7)]
    got = {r.id: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, 50: 50, 51: 50}
    assert max(plans) == 1
