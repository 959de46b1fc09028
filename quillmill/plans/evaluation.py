"""From a text table to loss and perplexity of its validation part."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.operators import bigram
from quillmill.operators.batching import assign_batches
from quillmill.operators.combine import combine_splits
from quillmill.operators.metrics import mean_loss, perplexity
from quillmill.operators.packing import pack_batches
from quillmill.operators.splits import percent_split, take_clamped
from quillmill.operators.tokenization import tokenize
from quillmill.session import materialize


def train_and_validation(
    files: Mapping[str, DataFrame], percent: float, order: Sequence[str]
) -> DataFrame:
    """One table with a ``split`` column; the validation part is carved out of train when there is none."""
    if "validation" in files:
        return combine_splits(files)
    return percent_split(files["train"], percent, order)


def packed_blocks(
    documents: DataFrame,
    vocab: DataFrame,
    block: int,
    order: Sequence[str],
    validation_percent: float = 5,
    group_size: int = 1000,
) -> DataFrame:
    """Carve out a validation split, tokenize, and pack every split by itself."""
    tagged = percent_split(documents, validation_percent, order)
    tokens = tokenize(tagged, vocab, keep=["split", *order])
    return pack_batches(tokens, block, order, group_size, by=["split"])


def batch_losses(
    blocks: DataFrame, batch_size: int, k: float, vocab_size: int, max_eval_samples: int | None = None
) -> DataFrame:
    """Fit the pair model on the train blocks and score the validation batches."""
    table = materialize(blocks, "blocks", ("split",))
    model = materialize(bigram.fit_bigram(table.where(F.col("split") == "train")), "pair-model")
    evaluated = table.where(F.col("split") == "validation")
    order = ["group_id", "block_id"]
    if max_eval_samples is not None:
        evaluated = take_clamped(evaluated, max_eval_samples, order)
    batched = materialize(assign_batches(evaluated, batch_size, order), "eval-batches")
    losses = bigram.score_rows(batched, model, k, vocab_size, ["batch_id"])
    sizes = batched.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    return losses.join(sizes, "batch_id").select("batch_id", "n", "loss")


def evaluate(records: DataFrame) -> DataFrame:
    """Mean loss and perplexity, as reported at the end of an evaluation."""
    return perplexity(mean_loss(records))
