import bisect
import hashlib
import itertools
import math
from collections import Counter

from pyspark.sql import functions as F

from corpusmill.operators import runlog as rl
from corpusmill.operators import scores as sc
from corpusmill.operators import textops as tx
from tests.conftest import SF01


def test_cross_entropy_anchor(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    r = sc.mean_cross_entropy(e, "embedding", "label").first()
    assert abs(r.loss - 4.165073773) < 1e-8
    assert abs(math.exp(r.loss) - 64.397433) < 1e-5


def test_softmax_topk_penalty(spark):
    df = spark.createDataFrame([([2.0, -1.0, 2.0, 0.5, 3.0], [1, 1, 3])], "z array<double>, h array<int>")
    r = df.select(sc.softmax("z").alias("p"), sc.topk_filter("z", 2).alias("k"),
                  sc.recency_penalty("z", "h", 2.0).alias("pen"), sc.topk_filter("z", 0).alias("off")).first()
    assert abs(sum(r.p) - 1) < 1e-12
    assert r.k == [2.0, float("-inf"), 2.0, float("-inf"), 3.0]  # ties at the cut are kept
    assert r.pen == [2.0, -0.5, 2.0, 0.25, 3.0]  # negative logits divided too
    assert r.off == [2.0, -1.0, 2.0, 0.5, 3.0]


def test_weighted_draw_edges(spark):
    nan = float("nan")
    rows = [(1, [0.0, 0.0, 3.0]), (2, [0.0, -1.0, nan]), (3, []), (4, None), (5, [None, 2.0, nan]), (6, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "id long, p array<double>")
    got = {r.id: r.i for r in df.select("id", sc.weighted_draw("p", 7, "id").alias("i")).collect()}
    assert got == {1: 2, 2: None, 3: None, 4: None, 5: 1, 6: 0}


def test_weighted_draw_many_items(spark):
    """Against a plain search in the running sums, over rows of 32,000 items."""
    n = 32_000
    df = spark.range(12).selectExpr("id", f"transform(sequence(1, {n}), i -> cast((i * 7919 + id) % 101 as double)) as p")
    got = {r.id: (r.i, r.p) for r in df.select("id", "p", sc.weighted_draw("p", 3, "id").alias("i")).collect()}
    for k, (i, p) in got.items():
        u = (int(hashlib.md5(f"3:{k}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        assert i == bisect.bisect_right(list(itertools.accumulate(p)), u * sum(p))
    assert len({i for i, _ in got.values()}) > 8


def test_weighted_draw_distribution(spark):
    p = [0.5, 0.3, 0.2, 0.0]
    df = spark.range(20000).select("id", F.array(*[F.lit(x) for x in p]).alias("p"))
    c = Counter(r.i for r in df.select(sc.weighted_draw("p", 7, "id").alias("i")).collect())
    assert c[3] == 0
    for i, q in enumerate(p[:3]):
        assert abs(c[i] / 20000 - q) < 0.02


def test_rank_within_hot_key(spark):
    rows = [(0 if i % 3 else 1 + i % 5, i * 7) for i in range(3000)]  # run 0 holds two thirds
    df = spark.createDataFrame(rows, "run long, ev long")
    got = {(r.run, r.ev): r.rank for r in rl.rank_within(df, "run", "ev", "rank", bucket_width=500).collect()}
    want = {}
    for run in {r for r, _ in rows}:
        for k, ev in enumerate(sorted(e for r, e in rows if r == run), 1):
            want[(run, ev)] = k
    assert got == want


def test_run_summary_first_best_and_resume(spark):
    ep = spark.createDataFrame([(1, 1, 3.0), (1, 2, 2.0), (1, 3, 2.0), (1, 4, 2.5)], "run_id long, epoch int, avg_loss double")
    r = rl.run_summary(ep).first()
    assert (r.last_loss, r.best_loss, r.best_epoch, r.epochs_completed) == (2.5, 2.0, 2, 4)
    out = rl.resume_history(ep.where("epoch <= 2"), ep.where("epoch >= 2")).orderBy("epoch").collect()
    assert [x.epoch for x in out] == [1, 2, 3, 4]


def test_tumbling_only_full_blocks(spark):
    log = spark.createDataFrame([(1, 1, s, float(s)) for s in range(1, 13)], "run_id long, epoch int, step int, loss double")
    got = sorted((r.block, r.avg_loss) for r in rl.tumbling_mean(log, 5).collect())
    assert got == [(0, 3.0), (1, 8.0)]


def test_truncate_at_stop(spark):
    df = spark.createDataFrame([
        ("Q", "Q A\n\nUser: more"),        # "\n\n" completes first
        ("User: hi", "User: hi there User: x\n\ny"),  # prompt's own stop is ignored
        ("p", "p no stop here  "),
        ("p", "pab\nQ:c"),
    ], "prompt string, text string")
    got = [r.t for r in df.select(tx.truncate_at_stop("text", "prompt").alias("t")).collect()]
    assert got == ["Q A", "User: hi there", "p no stop here", "pab"]


def test_prompt_guard(spark):
    df = spark.createDataFrame([("  ", [1]), ("ok", []), ("ok", [1]), ("", [])], "p string, ids array<int>")
    got = [r.g for r in df.select(tx.prompt_guard("p", "ids").alias("g")).collect()]
    assert got == [tx.MSG_EMPTY, tx.MSG_UNENCODABLE, None, tx.MSG_EMPTY]
    assert df.select(tx.default_prompt("p").alias("d")).collect()[3].d == "\n"


def test_epoch_losses_with_and_without_the_epoch_going_on(spark):
    from corpusmill.operators import runlog as rl

    rows = [(1, 1, s, float(s)) for s in (1, 2, 3, 4)] + [(1, 2, 1, 9.0)]
    log = spark.createDataFrame(rows, "run_id long, epoch int, step int, loss double")
    assert [tuple(r) for r in rl.epoch_losses(log, 4, 3).collect()] == [(1, 1, 2.0, 4.0)]
    assert sorted(tuple(r) for r in rl.epoch_losses(log, 4, 3, complete_only=False).collect()) == [(1, 1, 2.0, 4.0), (1, 2, 9.0, None)]
