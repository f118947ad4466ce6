import pytest
from pyspark.sql import functions as F

from corpusmill.functions import cleaning as cl
from corpusmill.operators import vocab as vb
from corpusmill.sources import corpus as io
from corpusmill.streaming import corpus_stream as cs
from tests.conftest import SF001


def test_manifest_roundtrip_defaults_and_check(spark, tmpdir_fresh):
    toks = spark.createDataFrame([(1, [1, 2, 3]), (2, [4])], "doc_id long, ids array<int>")
    m = io.dataset_manifest(toks, vocab_size=5, cleaned=False, cleaning_mode="strict")
    r = m.first()
    assert (r.total_tokens, r.train_split_index, r.val_tokens, r.cleaning_mode) == (4, 3, 1, None)
    io.write_manifest(m.drop("dtype", "tokenizer_type"), tmpdir_fresh + "/m")
    back = io.read_manifest(spark, tmpdir_fresh + "/m").first()
    assert back.dtype == "int16" and back.tokenizer_type == "character"
    assert io.validate_manifest(toks, m).first().ok
    with pytest.raises(Exception):
        io.validate_manifest(toks.limit(1), m).collect()
    assert io.manifest_path_for("data/x.bin") == "data/x_metadata.json"


def test_tokens_sink_types(spark, tmpdir_fresh):
    toks = spark.createDataFrame([(2, [4, 5]), (1, [1, 2, 3])], "doc_id long, ids array<int>")
    io.write_tokens(toks, tmpdir_fresh + "/t")
    t = io.read_tokens(spark, tmpdir_fresh + "/t", "int16")
    assert t.schema["ids"].dataType.elementType.typeName() == "short"
    assert sorted((r.doc_id, r.ids) for r in t.collect()) == [(1, [1, 2, 3]), (2, [4, 5])]


def test_text_corpus_newlines(spark, tmpdir_fresh):
    with open(tmpdir_fresh + "/a.txt", "w", newline="") as f:
        f.write("one\r\ntwo\rthree\n")
    d = io.read_corpus(spark, tmpdir_fresh + "/*.txt", fmt="text").first()
    assert d.text == "one\ntwo\nthree\n" and d.source_file == "a.txt"


def test_history_defaults(spark, tmpdir_fresh):
    spark.createDataFrame([(1, None)], "run_id long, epochs_completed int").write.json(tmpdir_fresh + "/h")
    h = io.read_history(spark, tmpdir_fresh + "/h").first()
    assert h.train_losses == [] and h.epochs_completed == 0


def test_streams_equal_batch(spark):
    glob = f"{SF001}/documents*.parquet"
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    s = {r.doc_id: r.text for r in cs.stream_clean(spark, glob, "strict").collect()}
    b = {r.doc_id: r.t for r in docs.select("doc_id", cl.clean_strict(F.col("text")).alias("t")).collect()}
    assert s == b
    v = cs.stream_char_vocab(spark, glob)
    assert sorted((r.id, r.ch) for r in v.collect()) == sorted(map(tuple, vb.char_vocab(docs).collect()))
    tot = cs.stream_totals(spark, glob, "strict").first()
    assert tot.docs == 200 and tot.chars_in == 485088 and tot.chars_out == 483383


def test_entry_and_catalogue(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["id", "ch"] and df.count() == 77
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    for name in ("clean_balanced", "char_vocab", "token_stream_offsets", "sample_windows", "cross_entropy",
                 "running_mean", "truncate_at_stop", "bpe_merges", "stream_clean", "dataset_manifest"):
        assert name in qs


def test_write_corpus_and_compression_report(spark, tmpdir_fresh):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    io.write_corpus(docs.withColumn("text", cl.clean_strict(F.col("text"))), tmpdir_fresh + "/clean")
    back = spark.read.parquet(tmpdir_fresh + "/clean")
    assert back.count() == 200 and back.agg(F.sum(F.length("text"))).first()[0] == 483383
    io.write_corpus(docs, tmpdir_fresh + "/txt", fmt="text")
    assert spark.read.text(tmpdir_fresh + "/txt", wholetext=False).count() > 200  # documents span lines
    codec = vb.CharCodec(vb.char_vocab(docs))
    toks = docs.select("doc_id", codec.encode(F.col("text")).alias("ids"))
    r = io.compression_report(spark, toks, tmpdir_fresh + "/cmp", "gzip").first()
    assert r.input_bytes > r.output_bytes > 0 and 0 < r.reduction_pct < 100


def _three_files(spark, folder):
    texts = [["abca", "é"], ["xyz ca", None, ""], ["a" * 50]]
    for k, part in enumerate(texts):
        spark.createDataFrame([(10 * k + i, t, "en", "s", 0) for i, t in enumerate(part)], cs.DOC_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/f{k}")
    return f"{folder}/in/*/*.parquet", [t for part in texts for t in part]


def test_progress_rows_run_up_to_the_batch_totals(spark, tmpdir_fresh):
    glob, texts = _three_files(spark, tmpdir_fresh)
    rows = sorted(cs.stream_progress(spark, glob, "balanced", max_files_per_trigger=1, encode=lambda c: F.split(c, " ")).collect(), key=lambda r: r.batch)
    assert len(rows) == 3 and [r.docs for r in rows][-1] == len(texts)
    assert all(x.share < y.share and x.docs < y.docs for x, y in zip(rows, rows[1:])) and rows[-1].share == 1.0
    assert rows[-1].chars_in == sum(len(t or "") for t in texts)
    words = spark.createDataFrame([(t,) for t in texts], "t string").agg(F.sum(F.size(F.split(cl.clean(F.col("t"), "balanced"), " ")))).first()[0]
    assert rows[-1].tokens == words
    last = cs.stream_totals(spark, glob).first()
    assert (last.docs, last.chars_in, last.tokens, last.percent) == (len(texts), rows[-1].chars_in, last.chars_out, 100.0)


def test_a_failure_between_batches_leaves_a_whole_table(spark, tmpdir_fresh, monkeypatch):
    from collections import Counter

    glob, texts = _three_files(spark, tmpdir_fresh)
    out, point, schema = tmpdir_fresh + "/out", cs._point, "ch string, n long"
    assert cs.published(spark, out, schema).count() == 0

    def failing(spark, out, version):
        if version == 1:
            raise RuntimeError("lost before it was published")
        point(spark, out, version)

    monkeypatch.setattr(cs, "_point", failing)
    with pytest.raises(Exception, match="lost before"):
        cs.stream_char_counts(spark, glob, out, max_files_per_trigger=1)
    first = {r.ch: r.n for r in cs.published(spark, out, schema).collect()}
    monkeypatch.setattr(cs, "_point", point)
    got = {r.ch: r.n for r in cs.stream_char_counts(spark, glob, out, max_files_per_trigger=1).collect()}
    assert got == Counter("".join(t or "" for t in texts)) and 0 < sum(first.values()) < sum(got.values())
