"""Left join with a table that has one row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot_keys: int = HOT_KEYS, frequency: str | None = None
) -> DataFrame:
    """``left`` left-joined with ``right``, whose ``on`` columns are unique and non-null.

    The ``hot_keys`` most frequent keys of ``left`` are joined by broadcast (their
    number is the size bound); every other key holds at most 1/(hot_keys+1) of the
    rows and goes through a shuffled merge join (``right`` has no size bound). ``left`` is scanned twice (three times
    when no ``frequency`` column of ``right`` says how often a key occurs in
    ``left``), so pass a materialized table when it is costly to compute.
    """
    on = list(on)
    values = [c for c in right.columns if c not in on and c != frequency]
    if frequency is not None:
        hot_right = right.orderBy(F.desc(frequency), *on).limit(hot_keys).drop(frequency)
        right = right.drop(frequency)
        return _joined(left, right, hot_right.withColumn("__hot", F.lit(True)), on, values)
    hot = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), *on).limit(hot_keys).drop("__n")
    hot_values = right.join(F.broadcast(hot), on, "left_semi")  # at most hot_keys rows
    hot_right = hot.join(hot_values, on, "left").withColumn("__hot", F.lit(True))
    return _joined(left, right, hot_right, on, values)


def _joined(left: DataFrame, right: DataFrame, hot_right: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    tagged = left.join(F.broadcast(hot_right), on, "left")
    done = tagged.where(F.col("__hot")).drop("__hot")
    cold = tagged.where(F.col("__hot").isNull()).drop("__hot", *values).join(right.hint("merge"), on, "left")
    columns = [*left.columns, *values]
    return done.select(*columns).unionByName(cold.select(*columns))
