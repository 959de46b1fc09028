"""What several operators of this subpackage share."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.session import materialize, scratch_path, small_batches

__all__ = ["WORD", "exact_hash", "locate", "materialize", "read", "scratch_path", "small_batches", "uniform"]

#: A word of the fixed contracts: a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def locate(key: Column, limits: Sequence, kind: str) -> Column:
    """How many of the ascending ``limits`` are <= ``key``, by binary search.

    ``limits`` becomes one constant of the SQL type ``array<kind>``; a struct limit is
    given as a dict, and a field left out is null, which sorts before every value.
    """
    if not limits:
        return F.lit(0)
    constant = F.from_json(F.lit(json.dumps(list(limits), default=str)), f"array<{kind}>")
    steps = [F.lit(1 << i) for i in reversed(range(len(limits).bit_length()))]
    return F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda found, step: F.when(F.get(constant, found + step - 1) <= key, found + step).otherwise(found),
    )


def uniform(*columns: Column) -> Column:
    """A repeatable number in [0, 1) from the columns' values."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def exact_hash(text: str | Column) -> Column:
    """The same for equal texts; null and empty count as equal."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
