"""Splits, slices, hold-outs and samples.

"First k rows" splits compare the order key with a cut key (see
``ordering.rank_cuts``), so the table itself is not exchanged. Cuts of a whole
table are literals and reach the Parquet scan as filters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.operators import ordering as o


def head_fraction_split(
    df: DataFrame,
    fractions: Mapping[str, float],
    order: Sequence[str],
    by: Sequence[str] = ("year", "month"),
    rest: str | None = None,
) -> DataFrame:
    """Consecutive head fractions of every shard, in the order of ``fractions``.

    A split of fraction f takes ``int(n * f)`` rows of a shard of n rows. Rows
    after the last one get ``rest``, or are left out.
    """
    names = list(fractions)
    cuts = {}
    for i, name in enumerate(names):
        shares = [float(fractions[m]) for m in names[: i + 1]]
        cuts[f"__cut_{name}"] = lambda n, shares=shares: sum(F.floor(n * F.lit(s)) for s in shares)
    joined = o.with_cuts(df, order, cuts, by)
    split = F.lit(rest)
    sharded = F.lit(True)
    for c in by:
        sharded = sharded & F.col(c).isNotNull()
    for name in reversed(names):
        split = F.when(o.before_cut(order, f"__cut_{name}"), F.lit(name)).otherwise(split)
    # a row without a shard belongs to none of its splits
    out = joined.withColumn("split", F.when(sharded, split).otherwise(F.lit(rest))).drop(*cuts)
    return out if rest is not None else out.where(F.col("split").isNotNull())


def percent_split(df: DataFrame, percent: float, order: Sequence[str]) -> DataFrame:
    """Tag the first ``percent``% of the rows as validation and the others as train."""
    cuts = {"__cut": lambda n: F.bround(n * F.lit(float(percent)) / F.lit(100.0))}
    joined = o.with_cuts(df, order, cuts)
    split = F.when(o.before_cut(order, "__cut"), "validation").otherwise("train")
    return joined.withColumn("split", split).drop("__cut")


def percent_slice(df: DataFrame, lo: float, hi: float, order: Sequence[str]) -> DataFrame:
    """Rows from ``lo``% to ``hi``% of the table; both limits round to nearest."""

    def at(percent: float):
        return lambda n: F.bround(n * F.lit(float(percent)) / F.lit(100.0))

    joined = o.with_cuts(df, order, {"__lo": at(lo), "__hi": at(hi)})
    kept = o.before_cut(order, "__hi")
    if lo > 0:
        kept = kept & ~o.before_cut(order, "__lo")
    return joined.where(kept).drop("__lo", "__hi")


def row_percent(df: DataFrame, percent: float | None, order: Sequence[str]) -> DataFrame:
    """First ``int(n * percent / 100)`` records; all of them without a percentage."""
    if percent is None:
        return df
    cuts = {"__cut": lambda n: F.floor(n * F.lit(float(percent)) / F.lit(100.0))}
    joined = o.with_cuts(df, order, cuts)
    return joined.where(o.before_cut(order, "__cut")).drop("__cut")


def random_holdout(df: DataFrame, fraction: float, seed: int, key: str) -> DataFrame:
    """Tag exactly ``round(n * fraction)`` random rows as eval, the rest as train.

    The random order is the md5 of key and seed, the same in every engine.
    """
    hashed = df.withColumn("__random", o.random_key(key, seed))
    order = ["__random", key]
    cuts = {"__cut": lambda n: F.bround(n * F.lit(float(fraction)))}
    joined = o.with_cuts(hashed, order, cuts, bucket=o.random_bucket("__random", digits=3))
    split = F.when(o.before_cut(order, "__cut"), "eval").otherwise("train")
    return joined.withColumn("split", split).drop("__cut", "__random")


#: As many rows may meet in one task.
HEAP_ROWS = 10_000


def take_first(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``min(n, len)`` rows.

    More than ``HEAP_ROWS`` stay where they are and are compared with the key of the first row
    beyond them, so ``order`` must then be unique and without nulls.
    """
    if n <= HEAP_ROWS:
        return df.orderBy(*order).limit(n)
    joined = o.with_cuts(df, order, {"__cut": lambda size: F.least(F.lit(n), size)})
    return joined.where(o.before_cut(order, "__cut")).drop("__cut")


take_clamped = take_first


def peek_random(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """``k`` random rows, for a look at the data."""
    hashed = df.withColumn("__random", o.random_key(key, seed))
    return hashed.orderBy("__random", key).limit(k).drop("__random")
