"""Work that is to be done once, or dealt over all tasks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators import dataset as ds
from corpusmill.operators import profile as pf
from corpusmill.sources import corpus as io


def counting(spark):
    """Token rows from a Python function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf(T.ArrayType(T.IntegerType()))
    def ids(n):
        calls.add(1)
        return list(range(n % 7))

    return calls, spark.range(300).repartition(4).select(F.col("id").alias("doc_id"), ids(F.col("id")).alias("ids"))


def test_tokens_are_made_once_for_a_sink(spark, tmpdir_fresh):
    calls, tokens = counting(spark)
    io.write_tokens(tokens, tmpdir_fresh + "/t")
    assert calls.value == 300
    assert [(r.doc_id, r.ids) for r in io.read_tokens(spark, tmpdir_fresh + "/t").orderBy("doc_id").collect()] == [(k, list(range(k % 7))) for k in range(300)]


def test_tokens_are_made_once_for_a_compression_report(spark, tmpdir_fresh):
    calls, tokens = counting(spark)
    r = io.compression_report(spark, tokens, tmpdir_fresh + "/c").first()
    assert calls.value == 300 and r.codec == "gzip" and r.input_bytes > 0 and r.output_bytes > 0
    both = [spark.read.parquet(f"{tmpdir_fresh}/c/{c}").orderBy("doc_id").collect() for c in ("none", "gzip")]
    assert both[0] == both[1] and len(both[0]) == 300


def test_text_is_cleaned_once_for_its_stats(spark):
    df = spark.createDataFrame([("a", "caf\u00e9 \U0001f600"), ("a", None), (None, "")], "lang string, text string")
    stats = pf.cleaning_stats(df, "balanced", by=["lang"])
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    once = pf.clean_table(df, "balanced")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == once.count("regexp_replace(") > 0
    assert {r.lang: (r.chars_before, r.chars_after) for r in stats.collect()} == {"a": (6, 4), None: (0, 0)}


def test_a_block_layout_shuffles_tokens_once(spark, tmpdir_fresh):
    tokens = spark.createDataFrame([(k, list(range(k % 50))) for k in range(200)], "doc_id long, ids array<int>").repartition(3)
    off = ds.token_offsets(tokens)
    blocks = ds.token_blocks(off, 16, ranged=True)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning(block") == 1 and "hashpartitioning(block" not in plan
    ds.write_blocks(blocks, tmpdir_fresh + "/b", ranged=True)
    kept = ds.read_blocks(spark, tmpdir_fresh + "/b")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, ds.token_blocks(off, 16).collect()))
    runs = [[r.block for r in spark.read.parquet(f).collect()] for f in kept.inputFiles()]
    assert all(r == sorted(r) for r in runs)


def test_lines_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    from corpusmill.plans import q_io

    spark.createDataFrame([(k, f"line {k % 5}\nx") for k in range(100)], "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    files, scan = [], io.scan_text
    monkeypatch.setattr(io, "scan_text", lambda spark, path, **more: (files.extend(spark.read.text(path).inputFiles()), scan(spark, path, **more))[1])
    got = {r.line: r.n for r in q_io.scan_text_corpus(spark, str(tmp_path)).collect()}
    assert got == {"x": 100, **{f"line {k}": 20 for k in range(5)}}
    assert len(files) > 2
