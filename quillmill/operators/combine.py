"""Unions, joins and set operations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD = ("year", "month")


def union_sources(documents: DataFrame, bibliography: DataFrame, debug: bool = False) -> DataFrame:
    """Documents followed by bibliography rows; documents only in debug mode."""
    return documents if debug else documents.unionByName(bibliography)


def join_manifest(manifest: DataFrame, files: DataFrame, on: str = "path") -> DataFrame:
    """Content of every listed file that exists."""
    return files.join(manifest, on, "inner")


def missing_files(manifest: DataFrame, files: DataFrame, on: str = "path") -> DataFrame:
    """Manifest rows without a file."""
    return manifest.join(files.select(on), on, "left_anti")


def combine_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """One table with a ``split`` column from one table per split."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(DataFrame.unionByName, tagged)


def shard_grid(spark: SparkSession, years: int = 24, months: int = 12) -> DataFrame:
    """Every (year, month) a corpus may have; years from 0, months from 1."""
    return spark.range(years * months).select(
        F.expr(f"cast(id div {months} as int)").alias("year"),
        (F.col("id") % months + 1).cast("int").alias("month"),
    )


def missing_shards(grid: DataFrame, present: DataFrame, on_missing: str = "skip") -> DataFrame:
    """Grid shards without a train or without a validation table.

    ``present`` has one row per (split, year, month). With ``on_missing='stop'``
    a missing shard raises, as a training run that needs all of them does.
    """
    if on_missing not in ("skip", "stop"):
        raise ValueError(f"on_missing is 'skip' or 'stop', not {on_missing!r}")
    seen = present.groupBy(*SHARD).agg(
        F.max((F.col("split") == "train").cast("int")).alias("train"),
        F.max((F.col("split") == "val").cast("int")).alias("val"),
    )
    missing = (
        grid.join(seen, list(SHARD), "left")
        .select(
            *SHARD,
            (F.coalesce(F.col("train"), F.lit(0)) == 0).alias("no_train"),
            (F.coalesce(F.col("val"), F.lit(0)) == 0).alias("no_val"),
        )
        .where(F.col("no_train") | F.col("no_val"))
    )
    if on_missing == "stop":
        first = missing.orderBy(*SHARD).first()
        if first is not None:
            raise FileNotFoundError(f"shard {first['year']}-{first['month']} is missing")
    return missing


def split_overlap(df: DataFrame) -> DataFrame:
    """Texts present in more than one split, with the rows they have."""
    return (
        df.groupBy(F.md5("text").alias("text_md5"))
        .agg(
            F.array_sort(F.collect_set("split")).alias("splits"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .where(F.size("splits") > 1)
    )
