"""Batches, optimizer steps and ranks on top of a dense row index."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.operators import ordering as o
from quillmill.operators.tokenization import pad_to_longest, tokenize, truncate
from quillmill.operators.vocab import PAD_ID
from quillmill.session import materialize


def _cut(df: DataFrame, batch_size: int, drop_last: bool) -> DataFrame:
    pos = F.col("__pos")
    out = df.withColumn("batch_id", F.floor(pos / batch_size)).withColumn(
        "pos_in_batch", (pos % batch_size).cast("int")
    )
    if drop_last:
        out = out.where((F.col("batch_id") + 1) * batch_size <= F.col("__total"))
    return out.drop("__pos", "__total")


def assign_batches(
    df: DataFrame, batch_size: int, order: Sequence[str], by: Sequence[str] = (), drop_last: bool = False
) -> DataFrame:
    """Consecutive batches in ``order``: adds ``batch_id`` and ``pos_in_batch``."""
    indexed = o.row_index(df, order, by, "__pos", total="__total")
    return _cut(indexed, batch_size, drop_last)


def padded_batches(
    df: DataFrame,
    vocab: DataFrame,
    max_length: int,
    batch_size: int,
    order: Sequence[str],
    text_col: str = "text",
    pad_id: int = PAD_ID,
) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows, tokenized, truncated, and padded to the batch's longest row.

    Adds batch_id, input_ids and attention_mask; the text is dropped. Batches are found from the
    order columns alone and texts are tokenized and cut where they are read, so one exchange, of
    at most ``max_length`` ids a row, brings a batch together.
    """
    cut = truncate(tokenize(df, vocab, text_col), max_length)
    ranged = o.with_group_ranges(cut, order, (), batch_size)
    at = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    batched = ranged.withColumn("batch_id", (F.col("__first") + F.floor(at / batch_size)).cast("long")).drop("__first")
    return pad_to_longest(batched, ["__range", "batch_id"], pad_id).drop("__range")


def shuffle_batches(
    df: DataFrame, batch_size: int, seed: int, epoch: int, key: str, drop_last: bool = False
) -> DataFrame:
    """Batches in a repeatable random order, a new one for every epoch."""
    indexed = o.random_index(df, key, (seed, epoch), "__pos", total="__total")
    return _cut(indexed, batch_size, drop_last)


def length_grouped_batches(
    df: DataFrame,
    batch_size: int,
    seed: int,
    key: str,
    length: str,
    mega: int | None = None,
    longest_first: bool = True,
    drop_last: bool = False,
) -> DataFrame:
    """Random megabatches of ``mega`` batches, each sorted by falling length.

    Without ``mega`` there are at least four megabatches, of at most 50 batches
    each. ``longest_first`` swaps the longest row of all (of the first megabatch
    that has one as long) with the very first row, so that a batch too large for
    the memory fails at once.
    """
    indexed = o.random_index(df, key, (seed,), "__pos", total="__total")
    batches = F.lit(mega) if mega else F.greatest(F.least(F.floor(F.col("__total") / (4 * batch_size)), F.lit(50)), F.lit(1))
    rows = batches * batch_size
    inside = Window.partitionBy("mega_id").orderBy(F.desc(length), "__pos")
    placed = indexed.withColumn("mega_id", F.floor(F.col("__pos") / rows)).withColumn(
        "__rank", F.row_number().over(inside) - 1
    )
    start = F.col("mega_id") * rows
    if longest_first:
        heads = placed.where(F.col("__rank") == 0)
        longest = heads.agg(F.max(F.struct(F.col(length).alias("len"), (-F.col("mega_id")).alias("m"))).alias("top"))
        swapped = F.abs(longest.select("top.m").scalar())
        # the first rows of megabatch 0 and of the longest one change places
        start = (
            F.when((F.col("__rank") == 0) & (F.col("mega_id") == 0), swapped * rows)
            .when((F.col("__rank") == 0) & (F.col("mega_id") == swapped), F.lit(0))
            .otherwise(start)
        )
    placed = placed.withColumn("__pos", start + F.col("__rank")).drop("__rank")
    return _cut(placed, batch_size, drop_last)


def shard_for_ranks(
    df: DataFrame,
    world: int,
    mode: str = "interleaved",
    batch_size: int | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Give rows to ``world`` workers; adds ``rank``.

    ``interleaved`` deals whole batches in turn (needs ``batch_id``).
    ``contiguous`` gives every rank one run of rows of equal length, a multiple of
    ``batch_size``; the table is extended with its rows from the first on, again and
    again if need be, to fill the last ranks (needs ``order``), and ``is_padding``
    marks those copies.
    """
    if mode == "interleaved":
        return df.withColumn("rank", F.pmod(F.col("batch_id"), F.lit(world)).cast("int"))
    if mode != "contiguous":
        raise ValueError(f"mode is 'interleaved' or 'contiguous', not {mode!r}")
    if order is None:
        raise ValueError("contiguous ranks need an order")
    step = batch_size or 1
    indexed = o.row_index(df, order, (), "__pos", total="__total")
    share = F.ceil(F.col("__total") / (world * step)) * step
    last = F.floor((share * world - 1 - F.col("__pos")) / F.col("__total"))
    extended = indexed.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    extended = extended.withColumn("is_padding", F.col("__copy") > 0).withColumn(
        "__pos", F.col("__pos") + F.col("__copy") * F.col("__total")
    )
    return (
        extended.withColumn("rank", F.floor(F.col("__pos") / share).cast("int"))
        .withColumn("pos_in_rank", F.col("__pos") % share)
        .drop("__pos", "__total", "__copy")
    )


def resume_point(step: int, steps_per_epoch: int, accum: int) -> tuple[int, int]:
    """(epoch to continue, batches of it to skip) after ``step`` optimizer steps."""
    return step // steps_per_epoch, step % steps_per_epoch * accum


def resume_point_by_batches(step: int, batches_per_epoch: int, accum: int) -> tuple[int, int]:
    """The same, counting every batch of an epoch, also those of an incomplete step."""
    return divmod(step * accum, batches_per_epoch)


def resume_from(df: DataFrame, step: int, steps_per_epoch: int, accum: int) -> DataFrame:
    """Batches that are still to be seen in the epoch being resumed."""
    _, skipped = resume_point(step, steps_per_epoch, accum)
    return df.where(F.col("batch_id") >= skipped)


def resume_point_of(checkpoint: str, batches_per_epoch: int, accum: int) -> tuple[int, int]:
    """(epoch to continue, batches of it to skip) after a checkpoint named ``epoch_<n>`` or ``step_<n>``.

    The name is the last part of a path; an ending (``.pt``) doesn't count. Epochs count from 0, and a
    checkpoint of epoch n continues with the whole of epoch n + 1.
    """
    found = re.fullmatch(r"(epoch|step)_([0-9]+)(\.[^.]*)?", checkpoint.rstrip("/").rsplit("/", 1)[-1])
    if found is None:
        raise ValueError(f"{checkpoint} is not named epoch_<n> or step_<n>")
    if found[1] == "epoch":
        return int(found[2]) + 1, 0
    return resume_point_by_batches(int(found[2]), batches_per_epoch, accum)


def write_batches(df: DataFrame, path: str) -> None:
    """Batches clustered by ``batch_id``, so that a reader of the later ones skips the row groups of the others."""
    df.repartitionByRange("batch_id").sortWithinPartitions("batch_id").write.mode("overwrite").parquet(path)


def resume_batches(spark: SparkSession, path: str, checkpoint: str, accum: int) -> DataFrame:
    """Rows of :func:`write_batches` still to be seen in the epoch that ``checkpoint`` continues, with ``epoch``.

    The limit reaches the scan as a filter on ``batch_id``; no rows if the table has none.
    """
    batches = spark.read.parquet(path)
    last = batches.agg(F.max("batch_id")).first()[0]
    epoch, skipped = (0, 0) if last is None else resume_point_of(checkpoint, last + 1, accum)
    return batches.where(F.col("batch_id") >= skipped).withColumn("epoch", F.lit(epoch))


def assign_steps(batches: DataFrame, accum: int) -> DataFrame:
    """Map micro-batches to optimizer steps.

    ``batches`` has one row per (epoch, batch_id). A step is taken whenever the
    running batch count over all epochs is a multiple of ``accum``, and at the end
    of an epoch of at most ``accum`` batches. Adds ``is_update`` and ``step`` (the
    step a batch contributes to, from 1); batches after the last step get the step
    that was never taken.
    """
    seen = o.row_index(batches, ["epoch", "batch_id"], (), "__seen")
    # written first: one row per epoch is then a broadcast by its true size
    per_epoch = materialize(
        batches.groupBy("epoch").agg(F.count(F.lit(1)).alias("__in_epoch"), F.max("batch_id").alias("__last")),
        "epochs",
    )
    marked = seen.join(per_epoch, "epoch").withColumn(
        "is_update",
        ((F.col("__seen") + 1) % accum == 0)
        | ((F.col("__in_epoch") <= accum) & (F.col("batch_id") == F.col("__last"))),
    )
    flagged = marked.drop("__seen", "__in_epoch", "__last")
    done = o.running(flagged, ["epoch", "batch_id"], {"__done": ("sum", F.col("is_update").cast("long"))})
    return done.withColumn("step", F.col("__done") - F.col("is_update").cast("long") + 1).drop("__done")


def collate(df: DataFrame, pad_id: int = PAD_ID, by: Sequence[str] = ()) -> DataFrame:
    """One row per batch: its rows padded to the longest and stacked in order.

    ``by`` are the columns that batches were assigned by, as their ids begin anew in each group.
    """
    padded = pad_to_longest(df, [*by, "batch_id"], pad_id)
    stacked = padded.groupBy(*by, "batch_id").agg(
        F.array_sort(F.collect_list(F.struct("pos_in_batch", "input_ids", "attention_mask"))).alias("__rows")
    )
    return stacked.select(
        *by,
        "batch_id",
        F.size("__rows").alias("n"),
        F.transform("__rows", lambda r: r["input_ids"]).alias("input_ids"),
        F.transform("__rows", lambda r: r["attention_mask"]).alias("attention_mask"),
    )
