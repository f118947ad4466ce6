import math

from corpusmill.llm.q_backoff import op8_backoff


def test_words_of_pairs_that_occur_once_back_off(spark, tmp_path):
    rows = [(1, "a b"), (2, "a b"), (3, "a c"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_words, r.n_pairs, r.score) for r in op8_backoff(spark, str(tmp_path)).collect()}
    assert got[4] == (0, 0, None)
    assert got[1][:2] == got[2][:2] == (2, 2) and abs(got[1][2] - math.log(2 / 3) / 2) < 2e-6
    assert got[3][:2] == (2, 1) and abs(got[3][2] - math.log(0.4 * 1 / 6) / 2) < 2e-6


def test_shuffle_files_go_when_a_table_is_stored(spark):
    import time
    from pathlib import Path

    from corpusmill.llm.common import stored

    tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {p for d in tops for p in Path(d).rglob("shuffle_*.data")}
    before = files()
    df = spark.range(5000).repartition(7, "id")
    out = stored(df, "test")
    end = time.time() + 10
    while (left := files() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert out.count() == df.count() == 5000  # what is written can still be used
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_rounds_share_the_buckets_and_give_the_same_scores(spark, monkeypatch):
    from corpusmill.llm import backoff

    docs = spark.createDataFrame([(k, " ".join(f"w{k * j % 13}" for j in range(1, 30 + k))) for k in range(40)] + [(99, None)], "doc_id long, text string")
    parts = []
    monkeypatch.setattr(backoff, "stored", lambda df, name, keep=backoff.stored: parts.append((name, out := keep(df, name))) or out)
    found = {}
    for rounds in (1, 2, 3):
        parts.clear()
        monkeypatch.setattr(backoff, "_ROUNDS", rounds)
        found[rounds] = sorted(backoff.score(docs, least_pair=2).collect())
        scores = [df.count() for name, df in parts if name == "pair-scores"]
        assert len(scores) == rounds and all(scores)
    assert found[1] == found[2] == found[3]
