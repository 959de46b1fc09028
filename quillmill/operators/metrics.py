"""Evaluation metrics over predictions, labels and losses."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.columns import IGNORE_INDEX, pad_right


def _shifted_pairs(preds: str, labels: str) -> Column:
    """A prediction at position i is about the label at i + 1."""
    n = F.least(F.size(preds), F.size(labels)) - 1
    usable = F.greatest(n, F.lit(0))
    return F.arrays_zip(
        F.slice(preds, F.lit(1), usable).alias("p"),
        F.slice(labels, F.lit(2), usable).alias("l"),
    )


def token_accuracy(
    df: DataFrame, by: Sequence[str] = (), mask: bool = False, preds: str = "preds", labels: str = "labels"
) -> DataFrame:
    """Share of right next-token predictions. ``mask`` leaves out ignored labels."""
    pairs = df.select(*by, _shifted_pairs(preds, labels).alias("__pairs"))
    if mask:
        pairs = pairs.withColumn("__pairs", F.filter("__pairs", lambda x: x["l"] != IGNORE_INDEX))
    hits = F.size(F.filter("__pairs", lambda x: x["p"] == x["l"]))
    out = pairs.groupBy(*by).agg(
        F.coalesce(F.sum(hits), F.lit(0)).alias("n_hits"),
        F.coalesce(F.sum(F.size("__pairs")), F.lit(0)).alias("n_predictions"),
    )
    return out.withColumn("accuracy", F.try_divide(F.col("n_hits"), F.col("n_predictions")))


def mean_loss(
    df: DataFrame, by: Sequence[str] = (), weighting: str = "batch", batch_size: int | None = None
) -> DataFrame:
    """Mean of batch losses.

    ``batch``: every batch weighs the same. ``sample``: weighted by the rows ``n``
    of a batch. ``gathered``: each loss is repeated ``batch_size`` times and the
    last batch cut to its rows, so it weighs by at most ``batch_size``.
    """
    loss, n = F.col("loss"), F.col("n")
    if weighting == "batch":
        mean = F.avg(loss)
    elif weighting == "sample":
        mean = F.sum(loss * n) / F.sum(n)
    elif weighting == "gathered":
        if batch_size is None:
            raise ValueError("gathered weighting needs the batch size")
        weight = F.least(n, F.lit(batch_size))
        mean = F.sum(loss * weight) / F.sum(weight)
    else:
        raise ValueError(f"unknown weighting {weighting!r}")
    return df.groupBy(*by).agg(mean.alias("mean_loss"), F.count(F.lit(1)).alias("n_batches"))


def perplexity(df: DataFrame, loss: str = "mean_loss") -> DataFrame:
    """exp of a mean loss; an overflow gives infinity."""
    return df.withColumn("perplexity", F.exp(F.col(loss)))


def evaluate_many(df: DataFrame, dataset: str = "dataset") -> DataFrame:
    """One pass over the records of several datasets; metric names get their prefix."""
    grouped = df.groupBy(dataset).agg(
        F.avg("loss").alias("loss"),
        F.exp(F.avg("loss")).alias("perplexity"),
        F.sum("n").cast("double").alias("samples"),
    )
    metrics = F.array(
        *[F.struct(F.lit(m).alias("m"), F.col(m).alias("v")) for m in ("loss", "perplexity", "samples")]
    )
    return grouped.select(dataset, F.explode(metrics).alias("x")).select(
        F.concat(F.lit("eval_"), F.col(dataset), F.lit("_"), F.col("x.m")).alias("metric"),
        F.col("x.v").alias("value"),
    )


def pad_predictions(
    df: DataFrame, columns: Sequence[str] = ("preds",), filler: int = IGNORE_INDEX, by: Sequence[str] = ()
) -> DataFrame:
    """Pad arrays of unequal length to the longest of the table, or of their group ``by`` (a batch).

    One long row makes every row of the table as long; by batch, only those beside it.
    """
    if by:
        group = Window.partitionBy(*by)
        padded = [pad_right(F.col(c), F.greatest(F.max(F.size(c)).over(group), F.lit(0)), filler).alias(c) for c in columns]
        return df.select(*[c for c in df.columns if c not in columns], *padded).select(*df.columns)
    longest = df.agg(*[F.max(F.size(c)).alias(c) for c in columns]).first()
    out = df
    for c in columns:
        out = out.withColumn(c, pad_right(F.col(c), F.lit(longest[c] or 0), filler))
    return out


def sample_count(df: DataFrame) -> DataFrame:
    """Rows seen, as the sum of the observed batch sizes."""
    return df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("num_samples"))


def speed_metrics(df: DataFrame, total_batch: int, prefix: str = "eval", tokens: str | None = None) -> DataFrame:
    """Samples, steps and tokens per second of rows with ``num_samples`` and ``runtime``."""
    steps = F.ceil(F.col("num_samples") / total_batch)
    runtime = F.col("runtime")
    rates = [
        F.round(runtime, 4).alias(f"{prefix}_runtime"),
        F.when(runtime == 0, 0.0)
        .otherwise(F.round(F.col("num_samples") / runtime, 3))
        .alias(f"{prefix}_samples_per_second"),
        F.when(runtime == 0, 0.0).otherwise(F.round(steps / runtime, 3)).alias(f"{prefix}_steps_per_second"),
    ]
    if tokens is not None:
        rates.append(
            F.when(runtime == 0, 0.0)
            .otherwise(F.round(F.col(tokens) / runtime, 3))
            .alias(f"{prefix}_tokens_per_second")
        )
    return df.select("*", *rates)


def score(
    df: DataFrame,
    load,
    inputs: Sequence[str],
    outputs: Mapping[str, str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Score rows with a user's model.

    ``load()`` runs once per task and returns ``predict(frame) -> frame`` over
    Arrow batches of the ``inputs`` columns; ``outputs`` gives the result columns
    and their types. Rows stay in their partition.
    """
    types = dict(df.dtypes)
    carried = list(dict.fromkeys(keep))
    schema = ", ".join([f"`{c}` {types[c]}" for c in carried] + [f"`{c}` {t}" for c, t in outputs.items()])
    wanted = list(inputs)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for frame in frames:
            result = predict(frame[wanted])
            yield pd.concat([frame[carried].reset_index(drop=True), result.reset_index(drop=True)], axis=1)

    return df.select(*dict.fromkeys([*carried, *wanted])).mapInPandas(run, schema)
