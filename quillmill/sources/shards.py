"""Shard tables: one Parquet tree partitioned by split, year and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators.splits import take_first

SHARD_COLUMNS = ("split", "year", "month")


def write_shards(df: DataFrame, root: str, by: Sequence[str] = SHARD_COLUMNS) -> None:
    """Write or replace the shards that occur in ``df``; others stay as they are.

    The rebalance hint gathers the rows of a shard but lets AQE split a large
    shard over many tasks and merge small ones, so files have an even size.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.partitionBy(*by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def read_shard(
    spark: SparkSession, root: str, split: str | None = None, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Rows of the named shards; only their folders are read."""
    df = spark.read.parquet(root)
    for name, value in (("split", split), ("year", year), ("month", month)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def present_shards(spark: SparkSession, root: str) -> DataFrame:
    """The shards a tree holds. Partition columns only: no data column is read."""
    return spark.read.parquet(root).select(*SHARD_COLUMNS).distinct()


def write_ranks(df: DataFrame, root: str) -> None:
    """One folder per rank, so that a consumer reads only its part."""
    write_shards(df, root, ("rank",))


def write_sample(df: DataFrame, n: int, path: str, order: Sequence[str]) -> None:
    """Keep the first ``n`` rows of a shard as a table of their own."""
    take_first(df, n, order).write.mode("overwrite").parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_run_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
