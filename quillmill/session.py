"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "quillmill") -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local master may fall back to a temporary folder of its own: on a
    cluster such a folder would vanish with the machine that holds it.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(CHECKPOINT_CONF, fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage in a way that outlives executors, keeps column pruning for the
    readers, and gives Catalyst the real size, so that a join with the result is
    broadcast only when it is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python gets at most ``rows`` rows at a time in what is executed inside; for steps that pass whole texts.

    Both sides hold a batch more than once, next to the JVM's heap.
    """
    before = int(spark.conf.get(BATCH_CONF))
    if before <= 0 or rows < before:
        spark.conf.set(BATCH_CONF, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, str(before))
