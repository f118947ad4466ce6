"""Structured Streaming forms (J1-J4): cleaning, vocabulary growth, running
totals and encoding, each draining a file source with ``availableNow``.

Streams keep their checkpoints and sinks under the session's checkpoint
folder (a shared location on a cluster), so a restarted driver resumes from
the last committed micro-batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import cleaning as cl
from corpusmill.operators.profile import char_array
from corpusmill.operators.vocab import CharCodec
from corpusmill.session import scratch_path

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def read_stream(spark: SparkSession, path_glob: str, schema: T.StructType = DOC_SCHEMA,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path_glob)


def _drain(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_clean(spark: SparkSession, path_glob: str, mode: str = "balanced",
                 out: str | None = None) -> DataFrame:
    """Read files as they arrive, clean each document, append to a Parquet
    sink (J1).  Returns the sink as a batch table."""
    out = out or scratch_path(spark, "stream-clean")
    s = read_stream(spark, path_glob).select("doc_id", cl.clean(F.col("text"), mode).alias("text"))
    q = (s.writeStream.format("parquet").option("path", out + "/data")
         .option("checkpointLocation", out + "/_checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    _drain(q)
    return spark.read.schema("doc_id long, text string").parquet(out + "/data")


def _point(spark: SparkSession, out: str, version: int) -> None:
    """Makes a version the current one: the last step of a micro-batch, a single file's commit."""
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(out + "/current")


def _versions(spark: SparkSession, out: str, below: int | None = None) -> int | None:
    """The latest published version (below a number)."""
    try:
        published = spark.read.schema("version long").parquet(out + "/current")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing published so far
    return published.where(F.col("version") < below if below is not None else F.lit(True)).agg(F.max("version")).first()[0]


def published(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The table as the last completed micro-batch left it; empty before the first.

    A reader sees a whole version at any time, also while the next one is written or
    after a crash in the middle of it."""
    version = _versions(spark, out)
    return spark.createDataFrame([], schema) if version is None else spark.read.schema(schema).parquet(f"{out}/v{version}")


def _updates_to_table(agg: DataFrame, keys: list[str], out: str, spark: SparkSession, schema: str) -> DataFrame:
    """Run a stateful aggregate in update mode: a micro-batch brings the keys that it
    changed, which replace theirs in the last version; the next version is written
    beside it and published last.  A batch that is run again after a crash starts from
    the version before it, so it is idempotent."""

    def write(batch: DataFrame, batch_id: int) -> None:
        last = _versions(batch.sparkSession, out, batch_id)
        if last is not None and keys:
            old = batch.sparkSession.read.schema(schema).parquet(f"{out}/v{last}")
            batch = old.join(batch.select(*keys), keys, "left_anti").select(*batch.columns).unionByName(batch)
        batch.write.mode("overwrite").parquet(f"{out}/v{batch_id}")
        _point(batch.sparkSession, out, batch_id)

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start())
    _drain(q)
    return published(spark, out, schema)


def stream_char_counts(spark: SparkSession, path_glob: str, out: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Character set growing over micro-batches as stateful ``(ch, n)`` counts.
    Ids are assigned afterwards in batch (see ``stream_char_vocab``)."""
    out = out or scratch_path(spark, "stream-vocab")
    s = read_stream(spark, path_glob, max_files_per_trigger=max_files_per_trigger).select(F.explode(char_array("text")).alias("ch"))
    return _updates_to_table(s.groupBy("ch").agg(F.count(F.lit(1)).alias("n")), ["ch"], out, spark, "ch string, n long")


def stream_char_vocab(spark: SparkSession, path_glob: str, out: str | None = None) -> DataFrame:
    counts = stream_char_counts(spark, path_glob, out)
    return counts.select((F.row_number().over(Window.orderBy("ch")) - 1).cast("int").alias("id"), "ch", "n")


PROGRESS = "batch long, docs long, chars_in long, chars_out long, tokens long, bytes long"


def stream_progress(spark: SparkSession, path_glob: str, mode: str = "balanced", encode=None, out: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Progress of a long run (J3): a row for each micro-batch with running totals of
    documents, characters in and out, tokens, and the share of the known input.

    ``encode`` is a column function from cleaned text to token ids (``bpe_encoder`` of a
    model, ``encode`` of a codec); without one a character is a token.  The known input
    is what matches ``path_glob`` when the stream is drained; the share counts bytes of
    files, each of which is read in one micro-batch.  A batch's row is a folder of its
    own that a repeated batch replaces."""
    out = out or scratch_path(spark, "stream-progress")
    cleaned = cl.clean(F.col("text"), mode)
    s = read_stream(spark, path_glob, max_files_per_trigger=max_files_per_trigger).select(
        F.length("text").alias("cin"), F.length(cleaned).alias("cout"),
        (F.size(encode(cleaned)) if encode else F.length(cleaned)).cast("long").alias("tokens"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))

    def write(batch: DataFrame, batch_id: int) -> None:
        files = batch.groupBy("file").agg(F.count(F.lit(1)).alias("docs"), *(F.sum(c).alias(c) for c in ("cin", "cout", "tokens")), F.max("size").alias("size"))
        row = files.agg(F.lit(batch_id).cast("long").alias("batch"), *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in (
            ("docs", "docs"), ("cin", "chars_in"), ("cout", "chars_out"), ("tokens", "tokens"), ("size", "bytes"))))
        row.coalesce(1).write.mode("overwrite").parquet(f"{out}/rows/part={batch_id}")

    q = (s.writeStream.foreachBatch(write).option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start())
    _drain(q)
    known = spark.read.format("binaryFile").load(path_glob).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    upto = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)  # a row for each micro-batch
    rows = spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(out + "/rows")
    return rows.select("batch", *(F.sum(c).over(upto).alias(c) for c in ("docs", "chars_in", "chars_out", "tokens")),
                       (F.sum("bytes").over(upto) / F.lit(known)).alias("share"))


def stream_totals(spark: SparkSession, path_glob: str, mode: str = "balanced", encode=None, out: str | None = None) -> DataFrame:
    """Global totals (J3): the last row of ``stream_progress``, with the share as percent."""
    last = stream_progress(spark, path_glob, mode, encode, out).orderBy(F.desc("batch")).limit(1)
    return last.select("docs", "chars_in", "chars_out", "tokens", F.round(100 * F.col("share"), 6).alias("percent"))


def stream_char_encode(spark: SparkSession, path_glob: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """Encode arriving documents with a fixed vocabulary (J4): the vocabulary
    (bounded by the alphabet) is folded into the expression - a stream-static
    map with no join state."""
    out = out or scratch_path(spark, "stream-encode")
    codec = CharCodec(vocab)
    s = read_stream(spark, path_glob).select("doc_id", codec.encode(F.col("text")).alias("ids"))
    q = (s.writeStream.format("parquet").option("path", out + "/data")
         .option("checkpointLocation", out + "/_checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    _drain(q)
    return spark.read.schema("doc_id long, ids array<int>").parquet(out + "/data")
