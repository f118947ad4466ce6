"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import checkpoint_dir


#: Rows in a batch that Spark hands to Python: texts may be long, so few of them.
BATCH_ROWS = 2500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole; sets the batch size for what follows."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(conf)) > BATCH_ROWS:
        spark.conf.set(conf, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving freed memory back to the system after each task: Spark
    keeps its Python workers, and what one task needed at most would count against the next."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return task


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the folder that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Whether Spark removes a query's shuffle files when it ends, not when the driver happens to collect its garbage.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: its lineage
    ends there, and a lost executor costs nothing that was computed.  The shuffle
    files of the write, which nothing reads again, are removed when it ends."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        writer.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no column (in any case) has it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def lower_ascii(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
