import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dataset as ds


def _tokens(spark):
    rows = [(i * 3 + 1, list(range(i * 100, i * 100 + (i * 7) % 23))) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, ids array<int>"), rows


def _flat(rows):
    return [x for _, ids in sorted(rows) for x in ids]


def test_offsets_match_brute_force(spark):
    df, rows = _tokens(spark)
    off = {r.doc_id: (r.n_tokens, r.start_pos) for r in ds.token_offsets(df, bucket_keys=12).collect()}
    pos = 0
    for d, ids in sorted(rows):
        assert off[d] == (len(ids), pos)
        pos += len(ids)


def test_stream_and_split_partition(spark):
    df, rows = _tokens(spark)
    flat = _flat(rows)
    t = ds.token_offsets(df, bucket_keys=15)
    s = sorted((r.pos, r.id) for r in ds.token_stream(t).collect())
    assert [i for _, i in s] == flat and [p for p, _ in s] == list(range(len(flat)))
    idx = int(len(flat) * 0.9)
    parts = ds.split_documents(t, idx).collect()
    train = [x for r in sorted(parts, key=lambda r: r.start_pos) if r.split == "train" for x in r.ids]
    val = [x for r in sorted(parts, key=lambda r: r.start_pos) if r.split == "val" for x in r.ids]
    assert train == flat[:idx] and val == flat[idx:]


def test_windows_are_slices_of_the_stream(spark):
    df, rows = _tokens(spark)
    flat = _flat(rows)
    t = ds.token_offsets(df)
    L = 16
    blocks = ds.token_blocks(t, L + 1)
    starts = ds.window_starts(spark, 0, len(flat), L, 8, 3, seed=5)
    w = ds.sample_windows(blocks, starts, L, L + 1).collect()
    assert len(w) == 24
    for r in w:
        assert 0 <= r.start < len(flat) - L - 1
        assert r.x == flat[r.start:r.start + L] and r.y == flat[r.start + 1:r.start + L + 1]
    for b in range(3):
        got = sorted((r.slot, r.start) for r in w if r.batch == b)
        assert [s for _, s in got] == sorted(s for _, s in got)


def test_windows_empty_range_raises(spark):
    with pytest.raises(ValueError):
        ds.window_starts(spark, 0, 10, 16, 2, 1, seed=1)


def test_sequential_blocks(spark):
    df, rows = _tokens(spark)
    flat = _flat(rows)
    L = 32
    t = ds.token_offsets(df)
    got = sorted((r.seq, r.x, r.y) for r in ds.sequential_blocks(ds.token_blocks(t, L, overlap=1), len(flat), L).collect())
    assert len(got) == (len(flat) - 1) // L
    for k, x, y in got:
        assert x == flat[k * L:(k + 1) * L] and y == flat[k * L + 1:(k + 1) * L + 1]


def test_dense_index_and_sampling(spark):
    df = spark.range(0, 1000, 7).withColumnRenamed("id", "k")
    idx = sorted((r.k, r.row_index) for r in ds.dense_index(df, "k", bucket_keys=50).collect())
    assert [i for _, i in idx] == list(range(len(idx)))
    a = ds.sample_without_replacement(df, 20, 3, "k").collect()
    assert len({r.k for r in a}) == 20
    b = ds.sample_with_replacement(df, 50, 3, "k").collect()
    assert sorted(r.draw for r in b) == list(range(50))


def test_context_tail(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],), ([1],), ([],)], "ids array<int>")
    got = [r.t for r in df.select(ds.context_tail("ids", 3).alias("t")).collect()]
    assert got == [[3, 4, 5], [1], []]


def test_offsets_with_clustered_keys(spark):
    # most keys packed in a narrow range, a few far away
    keys = list(range(1000)) + [10**12, 10**12 + 5, 2 * 10**12]
    rows = [(k, list(range(k % 7))) for k in keys]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    off = {r.doc_id: r.start_pos for r in ds.token_offsets(df, bucket_keys=64).collect()}
    pos = 0
    for k, ids in sorted(rows):
        assert off[k] == pos
        pos += len(ids)


def test_offsets_with_null_negative_and_hashed_keys(spark):
    rows = [(None, [1, 2])] + [(k, list(range(abs(k) % 5))) for k in (-2**63, -7, 0, 3, 2**62, 2**62 + 1, 2**62 + 2, 2**63 - 1)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    for bucket_keys in (1, 3, 100):
        got = {r.doc_id: (r.n_tokens, r.start_pos) for r in ds.token_offsets(df, bucket_keys=bucket_keys).collect()}
        pos = 0
        for k, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
            assert got[k] == (len(ids), pos)
            pos += len(ids)
    hashed = spark.range(3000).selectExpr("xxhash64(id) AS doc_id", "array_repeat(1, cast(id % 4 AS int)) AS ids")
    off = ds.token_offsets(hashed, bucket_keys=100)
    rows = sorted((r.start_pos, r.n_tokens) for r in off.collect())
    assert len(rows) == 3000 and max(s + n for s, n in rows) == sum(n for _, n in rows) == 4500


def test_repeated_keys_are_told(spark):
    df = spark.createDataFrame([(1, [1]), (1, [2])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="repeated key"):
        ds.token_offsets(df).collect()


def test_tokens_pass_through_no_window(spark):
    df, _ = _tokens(spark)
    plan = ds.token_offsets(df)._jdf.queryExecution().optimizedPlan()

    def windows(node):
        own = [node] if node.nodeName() == "Window" else []
        children = node.children()
        return own + [w for k in range(children.size()) for w in windows(children.apply(k))]

    found = windows(plan)
    assert found
    for w in found:
        output = w.output()
        names = {output.apply(k).name() for k in range(output.size())}
        assert "ids" not in names and "doc_id" not in names


def test_offsets_by_strings_and_structs(spark):
    """Any key that can be ordered, with a null and a hot prefix."""
    import random

    rng = random.Random(1)
    names = sorted({"hot/" + str(rng.randrange(10**6)) if rng.random() < 0.7 else rng.choice("aé日z") + str(rng.random()) for _ in range(200)})
    rows = [(n, rng.randrange(5)) for n in [*names, None]]
    rng.shuffle(rows)
    df = spark.createDataFrame([(n, (len(n or "") % 3, n), list(range(c))) for n, c in rows], "name string, place struct<part:int,name:string>, ids array<int>").repartition(3)

    def want(order):
        pos, out = 0, {}
        for n, c in sorted(rows, key=order):
            out[n] = pos
            pos += c
        return out

    got = {r.name: r.start_pos for r in ds.token_offsets(df, "name", bucket_keys=30).collect()}
    assert got == want(lambda r: (r[0] is not None, (r[0] or "").encode()))
    got = {r.name: r.start_pos for r in ds.token_offsets(df, "place", bucket_keys=30).collect()}
    assert got == want(lambda r: (len(r[0] or "") % 3, r[0] is not None, (r[0] or "").encode()))
    with pytest.raises(Exception, match="repeated key"):
        ds.token_offsets(df.union(df.limit(1)), "name").collect()


def test_tokens_are_made_once(spark):
    """What makes the token table runs once, whatever the offsets read it for."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(500).selectExpr("id doc_id", "array(1, 2, 3) ids").repartition(3).mapInArrow(run, "doc_id long, ids array<int>")
    assert ds.token_offsets(df, bucket_keys=50).where("start_pos = 3 * doc_id").count() == 500
    assert made.value == 500


def test_a_kept_layout_reads_only_what_windows_need(spark, tmpdir_fresh):
    ids = list(range(60_000))
    df = spark.createDataFrame([(k, ids[k * 100:(k + 1) * 100]) for k in range(600)], "doc_id long, ids array<int>")
    blocks = ds.token_blocks(ds.token_offsets(df), 17)
    ds.write_blocks(blocks, tmpdir_fresh + "/b", partitions=4, row_group_bytes=4096)
    starts = ds.window_starts(spark, 40_000, 40_400, 16, 4, 3, seed=2)
    some = ds.read_blocks(spark, tmpdir_fresh + "/b", starts, 17, ranges=3)
    rows = ds.sample_windows(some, starts, 16, 17).collect()
    assert len(rows) == 12 and all(r.x == ids[r.start:r.start + 16] and r.y == ids[r.start + 1:r.start + 17] for r in rows)
    # rows that leave the scan, before the filter above it
    some.collect()
    plan = some._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() < 900 < ds.read_blocks(spark, tmpdir_fresh + "/b").count()
    assert ds.read_blocks(spark, tmpdir_fresh + "/b", starts.limit(0), 17).count() == 0


@pytest.mark.parametrize("k", [0, 1, 7, 250, 499, 500, 800])
def test_sampling_keeps_the_smallest_hashes(spark, k):
    from corpusmill.functions.hashing import md5_bits

    df = spark.range(500).withColumnRenamed("id", "k").repartition(3)
    order = [r.k for r in df.withColumn("h", md5_bits(F.lit(9), "k")).orderBy("h", "k").collect()]
    assert sorted(r.k for r in ds.sample_without_replacement(df, k, 9, "k").collect()) == sorted(order[:k])
