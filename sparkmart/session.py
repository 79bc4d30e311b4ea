"""Session construction and the shared checkpoint folder.

The library never hard-codes a master: ``get_session`` is a convenience for
tests, the bench and the CLI.  On a cluster the caller owns the session and
``spark.checkpoint.dir`` must name a shared (HDFS / object store) folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = 4 << 20                # of rows that go to a Python task at once

# Settings every session of ours wants; all are plain public Spark confs.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",  # cp1252 files
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "sparkmart",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading it from the session.

    Only a local-mode session (tests, bench) without a configured folder gets a
    fresh scratch folder; a cluster session without one is an error, because a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="sparkmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_RUNS: list[str] = []                 # folders of the runs that are under way, the innermost last


@contextmanager
def run_scratch(spark: SparkSession):
    """Tables that ``reliable_checkpoint`` writes inside this block go to a folder of the
    run's own, removed at its end.  For runs whose results are written before it ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    _RUNS.append(path)
    try:
        yield path
    finally:
        _RUNS.remove(path)
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of a job started inside this block are removed as it ends.  Otherwise they
    stay until the driver happens to collect its garbage, so that the disk holds those of all jobs
    of a run at once.  For blocks whose jobs write what is read again."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)


def reliable_checkpoint(df: DataFrame, outlive: bool = False) -> DataFrame:
    """Cut lineage by writing a parquet table into the shared checkpoint
    folder and reading it back.

    Unlike ``Dataset.checkpoint`` (which, without a cache, computes the plan
    once to count and again to save, and stores Java-serialised rows) this
    computes the plan once and stores it columnar.  The folder is the one the
    cluster names in ``spark.checkpoint.dir``, so the table survives the loss
    of any executor.  ``outlive``: it stays when the innermost run's folder goes."""
    spark = df.sparkSession
    runs = _RUNS[:-1] if outlive else _RUNS
    root = runs[-1] if runs else ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/sparkmart-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python tasks in batches of about BATCH_BYTES
    (Spark's own limits are 10,000 rows and 64 MB): of whole texts, a task's buffers in the
    JVM and its batch in Python are that large, whatever the texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
