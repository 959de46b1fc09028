"""Corpus statistics and step plans: partial aggregation, then a few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.operators import ordering as o


def corpus_stats(df: DataFrame, by: Sequence[str] = ("split", "year", "month")) -> DataFrame:
    """Papers and tokens of every shard."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("papers"),
        F.coalesce(F.sum(F.size("input_ids")), F.lit(0)).alias("total_tokens"),
    )


def total_chunks(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counted blocks, from the marker on the first block of every document."""
    counted = F.when(F.col("num_chunks") != -1, F.col("num_chunks"))
    return df.groupBy(*by).agg(F.coalesce(F.sum(counted), F.lit(0)).alias("total_chunks"))


def split_counts(df: DataFrame, grid: DataFrame, splits: Sequence[str]) -> DataFrame:
    """Rows of every split of every grid shard; empty ones show 0."""
    counted = df.groupBy("split", "year", "month").agg(F.count(F.lit(1)).alias("n"))
    expected = grid.select("*", F.explode(F.array(*[F.lit(s) for s in splits])).alias("split"))
    return expected.join(counted, ["split", "year", "month"], "left").select(
        "split",
        "year",
        "month",
        F.coalesce("n", F.lit(0)).alias("n_rows"),
        F.col("n").isNull().alias("is_empty"),
    )


def split_rollup(df: DataFrame) -> DataFrame:
    """Row counts by split, year and month with all subtotals."""
    return df.rollup("split", "year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def num_examples(df: DataFrame, batch_size: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Number of rows; with a batch size, the estimate batches * batch size.

    ``by`` are the columns that batches were assigned by, as their ids begin anew in each group.
    """
    if batch_size is None:
        return df.agg(F.count(F.lit(1)).alias("num_examples"))
    return df.agg((F.count_distinct(*by, "batch_id") * batch_size).alias("num_examples"))


def num_tokens(
    df: DataFrame, max_steps: int | None = None, padded: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Tokens of the table; with ``max_steps``, the first batch's tokens times steps.

    ``padded`` counts what a batch holds once its rows are as long as its longest. ``by`` are the
    columns that batches were assigned by; with ``max_steps`` there is then a row for each group.
    """
    n = F.size("input_ids")
    if max_steps is not None:
        first = df.where(F.col("batch_id") == 0).groupBy(*by)
        held = F.count(F.lit(1)) * F.max(n) if padded else F.sum(n)
        return first.agg((F.coalesce(held, F.lit(0)) * max_steps).alias("num_tokens"))
    if padded:
        df = df.groupBy(*by, "batch_id").agg((F.count(F.lit(1)) * F.max(n)).alias("__held"))
        n = F.col("__held")
    return df.agg(F.coalesce(F.sum(n), F.lit(0)).alias("num_tokens"))


def step_plan(
    df: DataFrame,
    batch_size: int,
    accum: int,
    epochs: float = 1.0,
    max_steps: int = 0,
    by: Sequence[str] = ("year", "month"),
    rounding: str = "floor",
    world: int = 1,
) -> DataFrame:
    """Batches, optimizer steps per epoch, total steps and epochs of every shard.

    ``rounding='floor'`` drops the steps of an incomplete accumulation but takes at
    least one per epoch; ``'ceil'`` counts them.
    """
    if rounding not in ("floor", "ceil"):
        raise ValueError(f"rounding is 'floor' or 'ceil', not {rounding!r}")
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_examples"))
    per_batch = batch_size * world
    batches = counted.withColumn("n_batches", F.ceil(F.col("n_examples") / per_batch))
    ratio = F.col("n_batches") / accum
    updates = F.greatest(F.floor(ratio), F.lit(1)) if rounding == "floor" else F.ceil(ratio)
    planned = batches.withColumn("updates_per_epoch", updates)
    per_epoch = F.col("updates_per_epoch")
    if max_steps > 0:
        total: Column = F.lit(max_steps).cast("long")
        n_epochs = F.ceil(F.lit(max_steps) / per_epoch)
        samples: Column = F.lit(float(max_steps * per_batch * accum))
    else:
        total = F.ceil(per_epoch * F.lit(float(epochs)))
        n_epochs = F.ceil(F.lit(float(epochs)))
        samples = F.col("n_examples") * F.lit(float(epochs))
    if rounding == "ceil":
        n_epochs = F.ceil(total / per_epoch)
    return planned.select(
        *by,
        "n_examples",
        "n_batches",
        "updates_per_epoch",
        total.alias("total_steps"),
        n_epochs.alias("n_epochs"),
        samples.alias("n_samples"),
    )


def tokens_seen(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), tokens: str = "n_tokens") -> DataFrame:
    """Running number of tokens after every step."""
    return o.running(df, order, {"tokens_seen": ("sum", F.col(tokens).cast("long"))}, by)


def total_flos(df: DataFrame, flos_per_token: float, by: Sequence[str] = ()) -> DataFrame:
    """Floating-point operations of one pass, from a cost per token."""
    # exact integer sum first, one multiplication after: no order-dependent rounding
    tokens = F.coalesce(F.sum(F.size("input_ids").cast("long")), F.lit(0))
    return df.groupBy(*by).agg((tokens.cast("double") * F.lit(float(flos_per_token))).alias("total_flos"))


def table_size(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Size of the text in MB (bytes / 1,000,000)."""
    return df.agg((F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)) / F.lit(1e6)).alias("size_mb"))
