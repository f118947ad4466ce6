"""Readers and writers (A1-A14): corpora, token tables, manifests,
vocabularies, BPE models, run histories and reports.

Everything is written with Spark's own writers into folders; small one-row
documents (manifest, vocabulary, history) are single-row JSON datasets.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators import bpe as bpe_ops
from corpusmill.session import scratch_path

# ---- A1-A3: corpus ------------------------------------------------------------------------------


def normalize_newlines(c) -> Column:
    """What reading in text mode does: ``\\r\\n`` and lone ``\\r`` become ``\\n`` (A2)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, "\r\n?", "\n")


#: Bytes of a piece of a large text file, at least: it ends with the line that reaches them.
PIECE_BYTES = 1 << 20


def _first_bad(text: Column) -> Column:
    """Offset of the first byte of a string that is not UTF-8."""
    mark = "\ufffd"
    parts = F.split(F.make_valid_utf8(text), mark)
    upto = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.octet_length(F.array_join(F.slice(parts, 1, k), mark)))
    # a mark that the text itself has is no error
    return F.filter(upto, lambda at: F.substr(text.cast("binary"), at + 1, F.lit(3)) != F.lit(mark.encode()))[0]


def scan_text(spark: SparkSession, path: str, separator: str = "\n", piece_bytes: int = PIECE_BYTES, strict: bool = True) -> DataFrame:
    """Large text files, read in byte ranges (A1): ``(source_file, source_size, offset, text)``.

    Spark's text source splits a file at any byte and gives each line to the range that
    it starts in, so no code point and no ``\\r\\n`` is cut.  With the separator
    ``\\n`` consecutive lines of a range make pieces of ``piece_bytes`` or a little more
    (a piece's text ends with its line's end; a file's pieces in order are the file);
    with any other separator each piece is the document between two of them.
    ``offset`` is the byte at which a piece starts: inside a range a running sum that is
    taken where the range is read, and each range's own start is the sum of those
    before it (one row for each range).  ``(source_file, offset)`` is unique and has
    the corpus's order.  A byte order mark at a file's start belongs to no text.

    ``strict``: a byte that is no UTF-8 is an error that names file and offset, as a
    strict read raises one; else such bytes become U+FFFD.  Compressed files can't be
    split and are refused.  An empty file has no rows.
    """
    gap = len(separator.encode())
    lines = separator == "\n"
    # a value may be no UTF-8: it goes to Python as bytes
    raw = (spark.read.option("lineSep", separator).text(path)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
                   F.col("value").cast("binary").alias("value")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, held, size = None, 0, [], 0

        def piece() -> pa.RecordBatch:
            raw = separator.encode().join([*held, b""]) if lines else held[0]
            cols = ([now[0]], [now[1]], [now[2]], [at], [size], [raw])
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["file", "size", "block", "at", "bytes", "raw"])

        for b in batches:
            own = zip(*(b.column(c).to_pylist() for c in ("file", "size", "block")))
            for block, value in zip(own, b.column("value")):
                if block != now or size >= piece_bytes or held and not lines:
                    if held:
                        yield piece()
                    at = at + size if block == now else 0
                    now, held, size = block, [], 0
                held.append(value.as_py())
                size += len(held[-1]) + gap
        if held:
            yield piece()

    pieces = raw.mapInArrow(pack, "file string, size long, block long, at long, bytes long, raw binary")
    # written once: a range's rows are read in its order by one task, whatever comes after
    folder = scratch_path(spark, "pieces")
    pieces.write.parquet(folder)
    pieces = spark.read.parquet(folder)
    blocks = pieces.groupBy("file", "size", "block").agg(F.sum("bytes").alias("bytes"))
    order = Window.partitionBy("file").orderBy("block")  # a row for each range
    whole = Window.partitionBy("file")
    before = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    # bytes of the lines found, less those of the file: a last line without its end adds one separator, a mark lacks three
    over = F.sum("bytes").over(whole) - F.col("size")
    placed = blocks.select("file", "block", before.alias("before"), over.alias("over"), (F.col("block") == F.max("block").over(whole)).alias("last"))
    marked = F.when(F.col("over") < 0, F.lit(3)).otherwise(F.lit(0))
    checked = F.when(~F.col("over").isin(0, gap, -3, gap - 3), F.raise_error(F.concat(F.lit("not a plain text file: "), F.col("file")))).otherwise(F.col("before") + marked)
    found = (pieces.join(placed, ["file", "block"]).withColumn("offset", checked + F.col("at"))
             .withColumn("text", F.col("raw").cast("string")))
    if lines:  # the file's last line has no end that isn't there
        ended = F.col("last") & (F.col("offset") + F.col("bytes") > F.col("size"))
        found = found.withColumn("text", F.when(ended, F.expr("cast(substring(raw, 1, length(raw) - 1) as string)")).otherwise(F.col("text")))
    good = F.is_valid_utf8("text")
    if strict:
        wrong = F.concat(F.lit("not UTF-8: "), F.col("file"), F.lit(", byte "), (F.col("offset") + _first_bad(F.col("text"))).cast("string"))
        found = found.withColumn("text", F.when(good, F.col("text")).otherwise(F.raise_error(wrong)))
    else:
        found = found.withColumn("text", F.make_valid_utf8("text"))
    return found.select(F.col("file").alias("source_file"), F.col("size").alias("source_size"), "offset", "text")


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", text_col: str = "text") -> DataFrame:
    """Scan a corpus (A1).  ``parquet``: a table with a text column; ``text``:
    every file is one document (whole-file read), keyed by a hash of its path;
    ``lines``: files of any size in pieces (``scan_text``), keyed by ``doc_id``, a
    struct of file and offset that has the corpus's order.
    Newlines are normalized as a text-mode read would; ``source_file`` and
    ``source_size`` carry the provenance of each row (A14)."""
    if fmt == "lines":
        df = scan_text(spark, path)
        return df.select(F.struct("source_file", "offset").alias("doc_id"), normalize_newlines("text").alias(text_col), "source_file", "source_size")
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "text":
        df = (spark.read.text(path, wholetext=True).withColumnRenamed("value", text_col)
              .withColumn("doc_id", F.xxhash64(F.col("_metadata.file_path"))))
    else:
        raise ValueError(f"unknown corpus format: {fmt}")
    return (df.withColumn(text_col, normalize_newlines(text_col))
            .withColumn("source_file", F.col("_metadata.file_name"))
            .withColumn("source_size", F.col("_metadata.file_size")))


def write_corpus(df: DataFrame, path: str, fmt: str = "parquet", text_col: str = "text") -> None:
    """Write a (cleaned) corpus (A3)."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif fmt == "text":
        df.select(text_col).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown corpus format: {fmt}")


# ---- A4-A6: token tables ----------------------------------------------------------------------------

DTYPES = {"int16": "smallint", "int32": "int"}


#: Keys in a range of a token table on average, at least: a small table is not to be many small files.
RANGE_KEYS = 32
#: Bytes of a row group of a token table, about, and its rows at most.  Spark reads 4,096 rows at
#: once, or a row group where it has fewer; documents have thousands of tokens.
TOKEN_GROUP_BYTES = 1 << 20
TOKEN_GROUP_ROWS = 512
#: Widths in which the ids of a row are dealt out: the narrowest that holds them all.
_WIDTHS = {"_1": ("tinyint", 1 << 7), "_2": ("smallint", 1 << 15), "_4": ("int", 1 << 31)}


def write_tokens(tokens: DataFrame, path: str, key: str = "doc_id", ids: str = "ids",
                 compression: str = "snappy", partitions: int | None = None) -> None:
    """Token ids in document order (A4): dealt out by ranges of the document key and
    sorted by it, so part files follow the stream order.

    The ranges are found from the keys alone, so what makes the ids runs once and the
    tokens are not stored a second time.  Shuffle and sort hold the ids of a row in one, two or
    four bytes each; they are integers in the table, whose row groups are small."""
    rows = tokens.select(F.col(key).alias("_k"), F.col(ids).cast("array<int>").alias("_ids"))
    tops, many = _key_ranges(rows.select("_k"), partitions)
    # binary search: the number of tops that are less than the key; a null key comes first
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(many.bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.try_element_at("_tops", at + step) < F.col("_k"), at + step).otherwise(at))
    dealt = (rows.crossJoin(F.broadcast(tops)).select("_k", F.least(found, F.lit(many - 1)).alias("_range"), *_packed("_ids"))
             .repartitionById(many, "_range").sortWithinPartitions("_k"))
    whole = F.coalesce(*[F.col(name).cast("array<int>") for name in _WIDTHS])
    (dealt.select(F.col("_k").alias(key), whole.alias(ids)).write.mode("overwrite").option("compression", compression)
     .option("parquet.block.size", TOKEN_GROUP_BYTES).option("parquet.block.row.count.limit", TOKEN_GROUP_ROWS).parquet(path))


def _key_ranges(keys: DataFrame, partitions: int | None = None) -> tuple[DataFrame, int]:
    """``(_tops)``, one row with the largest key of each range of ``_k`` in order, and the number of ranges at most."""
    spark, path = keys.sparkSession, scratch_path(keys.sparkSession, "keys")
    keys.write.parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    many = partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                             max(spark.sparkContext.defaultParallelism, keys.count() // RANGE_KEYS))
    tops = keys.repartitionByRange(many, "_k").withColumn("_b", F.spark_partition_id()).groupBy("_b").agg(F.max("_k").alias("_top"))
    return tops.agg(F.array_sort(F.collect_list("_top")).alias("_tops")), many


def _packed(ids: str) -> list[Column]:
    """The ids of a row in the first of ``_WIDTHS`` that holds them, null in the others."""
    out, wider = [], F.lit(True)
    for name, (kind, limit) in _WIDTHS.items():
        # no ids: any width
        fits = F.coalesce((F.array_min(ids) >= -limit) & (F.array_max(ids) < limit), F.lit(True))
        out.append(F.when(wider & fits, F.col(ids).cast(f"array<{kind}>")).alias(name))
        wider = wider & ~fits
    return out


def read_tokens(spark: SparkSession, path: str, dtype: str = "int32", ids: str = "ids") -> DataFrame:
    """Typed scan of a token table (A5): ``int16`` -> SMALLINT, ``int32`` -> INT."""
    if dtype not in DTYPES:
        raise ValueError(f"unsupported dtype: {dtype}")
    df = spark.read.parquet(path)
    return df.withColumn(ids, F.col(ids).cast(f"array<{DTYPES[dtype]}>"))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the data files under a folder (file metadata only)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def _write_sorted(t: DataFrame, path: str, compression: str) -> None:
    """A stored token table in document order, in as few files and row groups as Spark makes: other
    files than ``write_tokens`` makes have other sizes, and the report gives sizes."""
    t.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.mode("overwrite").option("compression", compression).parquet(path)


def compression_report(spark: SparkSession, tokens: DataFrame, path: str, codec: str = "gzip") -> DataFrame:
    """Write the token table plain and with ``codec``; report both sizes and
    the reduction ``(1 - out/in) * 100`` (A6)."""
    plain, packed = path.rstrip("/") + "/none", path.rstrip("/") + f"/{codec}"
    staged = scratch_path(spark, "unsorted")
    rows = tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    rows.write.parquet(staged)  # finding the ranges is a pass of its own: what makes the tokens runs once
    _write_sorted(spark.read.schema(rows.schema).parquet(staged), plain, "none")
    _write_sorted(spark.read.parquet(plain), packed, codec)
    a, b = folder_bytes(spark, plain), folder_bytes(spark, packed)
    return spark.createDataFrame([(codec, a, b, (1 - b / a) * 100 if a else 0.0)],
                                 "codec string, input_bytes long, output_bytes long, reduction_pct double")


# ---- A7-A9: dataset manifest ----------------------------------------------------------------------------

MANIFEST_SCHEMA = T.StructType([
    T.StructField("total_tokens", T.LongType()),
    T.StructField("vocab_size", T.IntegerType()),
    T.StructField("tokenizer_type", T.StringType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("bytes_per_token", T.IntegerType()),
    T.StructField("train_split", T.DoubleType()),
    T.StructField("train_split_index", T.LongType()),
    T.StructField("train_tokens", T.LongType()),
    T.StructField("val_tokens", T.LongType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_size_bytes", T.LongType()),
    T.StructField("bin_file", T.StringType()),
    T.StructField("tokenizer_file", T.StringType()),
    T.StructField("cleaned", T.BooleanType()),
    T.StructField("cleaning_mode", T.StringType()),
    T.StructField("bpe_vocab_size_requested", T.IntegerType()),
    T.StructField("bpe_min_frequency", T.IntegerType()),
    T.StructField("created", T.StringType()),
])


def dataset_manifest(tokens: DataFrame, vocab_size: int, tokenizer_type: str = "bpe", dtype: str = "int32",
                     train_split: float = 0.9, source_file: str = "", source_size_bytes: int = 0,
                     output_name: str = "tokens", tokenizer_file: str = "bpe_tokenizer.json",
                     cleaned: bool = False, cleaning_mode: str | None = None,
                     vocab_size_requested: int = 32000, min_frequency: int = 2, ids: str = "ids") -> DataFrame:
    """One-row manifest of a token dataset (A7): one aggregate over the token
    table plus literals.  ``cleaning_mode`` is recorded only when cleaned."""
    total = F.coalesce(F.sum(F.size(ids)), F.lit(0)).cast("bigint")
    idx = (total.cast("double") * F.lit(float(train_split))).cast("bigint")
    return tokens.agg(
        total.alias("total_tokens"),
        F.lit(int(vocab_size)).alias("vocab_size"),
        F.lit(tokenizer_type).alias("tokenizer_type"),
        F.lit(dtype).alias("dtype"),
        F.lit(2 if dtype == "int16" else 4).alias("bytes_per_token"),
        F.lit(float(train_split)).alias("train_split"),
        idx.alias("train_split_index"),
        idx.alias("train_tokens"),
        (total - idx).alias("val_tokens"),
        F.lit(os.path.basename(source_file)).alias("source_file"),
        F.lit(int(source_size_bytes)).cast("bigint").alias("source_size_bytes"),
        F.lit(f"{output_name}.bin").alias("bin_file"),
        F.lit(tokenizer_file).alias("tokenizer_file"),
        F.lit(bool(cleaned)).alias("cleaned"),
        F.lit(cleaning_mode if cleaned else None).cast("string").alias("cleaning_mode"),
        F.lit(int(vocab_size_requested)).alias("bpe_vocab_size_requested"),
        F.lit(int(min_frequency)).alias("bpe_min_frequency"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("created"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(path)


def manifest_path_for(bin_path: str) -> str:
    """``data.bin`` -> ``data_metadata.json`` (the path rule of the readers)."""
    return bin_path[:-4] + "_metadata.json" if bin_path.endswith(".bin") else bin_path + "_metadata.json"


def read_manifest(spark: SparkSession, path: str, default_dtype: str = "int16",
                  default_tokenizer: str = "character") -> DataFrame:
    """Manifest with defaults for missing fields."""
    m = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path)
    return (m.withColumn("dtype", F.coalesce("dtype", F.lit(default_dtype)))
            .withColumn("tokenizer_type", F.coalesce("tokenizer_type", F.lit(default_tokenizer))))


def validate_manifest(tokens: DataFrame, manifest: DataFrame, ids: str = "ids") -> DataFrame:
    """Fail the query when the token count differs from ``total_tokens``.
    The two one-row aggregates are unioned and reduced - no join."""
    got = tokens.agg(F.coalesce(F.sum(F.size(ids)), F.lit(0)).cast("bigint").alias("actual"),
                     F.lit(None).cast("bigint").alias("expected"))
    exp = manifest.select(F.lit(None).cast("bigint").alias("actual"), F.col("total_tokens").cast("bigint").alias("expected"))
    j = got.unionByName(exp).agg(F.max("actual").alias("actual"), F.max("expected").alias("expected"))
    msg = F.concat(F.lit("token count "), F.col("actual").cast("string"), F.lit(" != manifest total_tokens "),
                   F.coalesce(F.col("expected").cast("string"), F.lit("null")))
    return j.select("actual", "expected",
                    F.when(F.col("actual") == F.col("expected"), F.lit(True)).otherwise(F.raise_error(msg)).alias("ok"))


# ---- A10: character vocabulary JSON ---------------------------------------------------------------------------

VOCAB_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("vocab_size", T.IntegerType()),
    T.StructField("char_to_idx", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("idx_to_char", T.MapType(T.StringType(), T.StringType())),
])


def vocab_document(vocab: DataFrame) -> DataFrame:
    """The vocabulary as one row with both maps (inverse keys are strings)."""
    return vocab.agg(
        F.lit("character").alias("type"),
        F.count(F.lit(1)).cast("int").alias("vocab_size"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("ch", "id")))).alias("char_to_idx"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("id").cast("string"), "ch")))).alias("idx_to_char"))


def save_vocab(vocab: DataFrame, path: str) -> None:
    vocab_document(vocab).coalesce(1).write.mode("overwrite").json(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``(id, ch)`` from a vocabulary JSON (a Spark folder or one indented file)."""
    doc = spark.read.schema(VOCAB_SCHEMA).option("multiLine", "true").json(path)
    return doc.select(F.explode("char_to_idx").alias("ch", "id")).select(F.col("id").cast("int"), "ch")


# ---- A11: BPE model -------------------------------------------------------------------------------------------------

def save_bpe(spark: SparkSession, model: bpe_ops.BpeModel | None, path: str) -> None:
    if model is None or not model.tokens:
        raise ValueError("no learned model to save")
    model.vocab_df(spark).coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + "/vocab")
    model.merges_df(spark).coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + "/merges")


def load_bpe(spark: SparkSession, path: str) -> bpe_ops.BpeModel:
    """Read a saved model; the vocabulary and merges are bounded by the
    vocabulary size, so they are held on the driver."""
    try:
        v = spark.read.parquet(path.rstrip("/") + "/vocab").orderBy("id").collect()
        m = spark.read.parquet(path.rstrip("/") + "/merges").orderBy("rank").collect()
    except Exception as e:  # noqa: BLE001 - Spark reports a missing path as AnalysisException
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"no saved model at {path}") from None
        raise
    tokens = [bytes.fromhex(r["token_hex"]).decode("utf-8") if r["is_special"] else bytes.fromhex(r["token_hex"])
              for r in v]
    return bpe_ops.BpeModel(tokens=tokens, merges=[(r["left_id"], r["right_id"], r["new_id"]) for r in m])


# ---- A12-A13: run history and reports ---------------------------------------------------------------------------------

def _ordered(col: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("epoch", col))), lambda s: s[col])


def training_history(epochs: DataFrame, total_epochs: int | None = None, train: str = "train_loss",
                     val: str = "val_loss") -> DataFrame:
    """Per run: loss arrays in epoch order, perplexities, bests and the first
    best epoch (1-based) (A12)."""
    h = epochs.groupBy("run_id").agg(
        F.max("epoch").cast("int").alias("epochs_completed"),
        _ordered(train).alias("train_losses"), _ordered(val).alias("val_losses"),
        F.min(train).alias("best_train_loss"), F.min(val).alias("best_val_loss"),
        F.min_by("epoch", F.struct(F.col(val), F.col("epoch"))).cast("int").alias("best_epoch"))
    h = (h.withColumn("train_perplexities", F.transform("train_losses", lambda x: F.exp(x)))
         .withColumn("val_perplexities", F.transform("val_losses", lambda x: F.exp(x))))
    if total_epochs is not None:
        h = h.withColumn("total_epochs", F.lit(int(total_epochs)))
    return h


def write_history(history: DataFrame, path: str) -> None:
    history.write.mode("overwrite").json(path)


HISTORY_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("epochs_completed", T.IntegerType()),
    T.StructField("train_losses", T.ArrayType(T.DoubleType())),
    T.StructField("val_losses", T.ArrayType(T.DoubleType())),
])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Stored history with resume defaults: missing arrays -> empty, count -> 0."""
    h = spark.read.schema(HISTORY_SCHEMA).json(path)
    return (h.withColumn("train_losses", F.coalesce("train_losses", F.array().cast("array<double>")))
            .withColumn("val_losses", F.coalesce("val_losses", F.array().cast("array<double>")))
            .withColumn("epochs_completed", F.coalesce("epochs_completed", F.lit(0))))


def run_report(history: DataFrame, dataset_bin: str, batch_size: int, learning_rate: float,
               duration_minutes: Column | float, device: str = "cpu") -> DataFrame:
    """Nested run report per run."""
    dur = duration_minutes if isinstance(duration_minutes, Column) else F.lit(float(duration_minutes))
    return history.select(
        "run_id",
        F.lit(dataset_bin).alias("dataset_bin"),
        F.struct(F.col("epochs_completed").alias("epochs"), F.lit(int(batch_size)).alias("batch_size"),
                 F.lit(float(learning_rate)).alias("learning_rate"), dur.alias("duration_minutes"),
                 F.lit(device).alias("device")).alias("training"),
        F.struct(F.element_at("train_losses", -1).alias("final_train_loss"),
                 F.element_at("val_losses", -1).alias("final_val_loss"),
                 F.exp(F.element_at("train_losses", -1)).alias("final_train_perplexity"),
                 F.exp(F.element_at("val_losses", -1)).alias("final_val_perplexity"),
                 F.col("best_val_loss"), F.col("best_epoch")).alias("performance"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("created"))
