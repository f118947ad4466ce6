"""Token tables: what a write stores and deals out, and rows that are unusual."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusmill.sources import corpus as io


def long_rows(spark, n):
    ids = F.transform(F.sequence(F.lit(1), F.lit(4000)), lambda x: (F.pmod(F.xxhash64(x, F.col("id")), F.lit(101))).cast("int"))
    return spark.range(n).select(F.col("id").alias("doc_id"), ids.alias("ids"))


def parts(path):
    return sorted(glob.glob(f"{path}/part-*.parquet"))


def folder_bytes(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_a_reader_gets_few_tokens_at_once(spark, tmpdir_fresh):
    # Spark's reader holds a batch of 4,096 rows, or a row group where it has fewer
    def groups(df, path):
        io.write_tokens(df, path, partitions=1)
        files = [pq.ParquetFile(f).metadata for f in parts(path)]
        return [m.row_group(k) for m in files for k in range(m.num_row_groups)]

    tokens = [g.column(1).num_values for g in groups(long_rows(spark, 1000), tmpdir_fresh + "/t")]
    assert sum(tokens) == 4_000_000 and max(tokens) < 2_000_000
    same = spark.range(1000).select(F.col("id").alias("doc_id"), F.array_repeat(F.lit(7), 4000).alias("ids"))  # next to no bytes
    assert max(g.num_rows for g in groups(same, tmpdir_fresh + "/s")) <= 512


def test_tokens_are_not_stored_twice(spark, tmpdir_fresh):
    scratch = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = folder_bytes(scratch)
    io.write_tokens(long_rows(spark, 1000), tmpdir_fresh + "/t")
    assert 0 < folder_bytes(scratch) - before < folder_bytes(tmpdir_fresh + "/t") / 10


def test_rows_are_dealt_out_in_few_bytes(spark):
    rows = spark.createDataFrame([(1, [0, 127]), (2, [-128, None]), (3, [128]), (4, [-32768]), (5, [32768]), (6, []), (7, [None]), (8, None)], "k int, ids array<int>")
    packed = rows.select("k", *io._packed("ids")).orderBy("k").collect()
    assert [tuple(r)[1:] for r in packed] == [([0, 127], None, None), ([-128, None], None, None), (None, [128], None), (None, [-32768], None),
                                              (None, None, [32768]), ([], None, None), ([None], None, None), (None, None, None)]
    assert [t for _, t in rows.select(*io._packed("ids")).dtypes] == ["array<tinyint>", "array<smallint>", "array<int>"]


def test_unusual_rows_come_back_in_key_order(spark, tmpdir_fresh):
    rows = [(k % 37, [k, None, -k] if k % 3 else [] if k % 2 else None) for k in range(400)]
    rows += [(None, [1, 200]), (None, [2**31 - 1, -2**31]), (5, [-128, 127]), (6, [128]), (6, [32768]), (-2**63, [3])]
    io.write_tokens(spark.createDataFrame(rows, "doc_id long, ids array<int>"), tmpdir_fresh + "/t")
    found = [(r["doc_id"], r["ids"]) for f in parts(tmpdir_fresh + "/t") for r in pq.read_table(f).to_pylist()]
    assert sorted(map(str, found)) == sorted(map(str, rows))
    keys = [(k is not None, k) for k, _ in found]
    assert keys == sorted(keys, key=lambda x: (x[0], x[1] or 0)) and len(parts(tmpdir_fresh + "/t")) > 1


def test_keys_of_any_order(spark, tmpdir_fresh):
    df = spark.range(300).select(F.struct((F.col("id") % 7).cast("string").alias("file"), F.col("id").alias("at")).alias("k"), F.array(F.col("id").cast("int")).alias("ids"))
    io.write_tokens(df, tmpdir_fresh + "/t", key="k")
    found = [tuple(r["k"].values()) for f in parts(tmpdir_fresh + "/t") for r in pq.read_table(f).to_pylist()]
    assert found == sorted((str(k % 7), k) for k in range(300))
    io.write_tokens(df.limit(0), tmpdir_fresh + "/none", key="k")
    assert spark.read.parquet(tmpdir_fresh + "/none").count() == 0


def test_a_document_without_tokens_has_no_row(spark, tmpdir_fresh):
    # as in the query's SQL; the first token of an empty array was an error
    spark.createDataFrame([(1, "ab"), (2, ""), (3, "b")], "doc_id long, text string").write.parquet(tmpdir_fresh + "/documents.parquet")
    found = entry.queries()["token_sink_roundtrip"](spark, tmpdir_fresh).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [(1, 2, 1, 0), (3, 1, 1, 1)]
