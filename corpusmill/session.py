"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "corpusmill",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC time and no UI.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir`` (or it was set on the
    context).  When neither is present, a local session gets a private folder so
    that ``DataFrame.checkpoint()`` works in tests; on a cluster it is an error,
    as executors don't share the driver's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint location for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    import uuid

    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df):
    """Round-robin the rows over the cluster's parallelism when the scan yields
    fewer partitions than that (a single-row-group file is one split).  Large
    inputs already have more splits than cores and pass through untouched."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the driver tables (one parquet file per table)."""
    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))
