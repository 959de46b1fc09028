"""From documents to block shards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.operators.combine import combine_splits, union_sources
from quillmill.operators.packing import DEFAULT_BLOCK, chunk_documents
from quillmill.operators.splits import head_fraction_split
from quillmill.operators.tokenization import tokenize

SHARD = ("split", "year", "month")


def split_manifests(
    train: DataFrame,
    test: DataFrame,
    train_fraction: float = 1.0,
    val_fraction: float = 0.5,
    test_fraction: float = 0.5,
    order: Sequence[str] = ("manifest_pos",),
) -> DataFrame:
    """Validation and test heads of the test manifest, train head of the train manifest."""
    held_out = head_fraction_split(test, {"val": val_fraction, "test": test_fraction}, order)
    return head_fraction_split(train, {"train": train_fraction}, order).unionByName(held_out)


def with_bibliography(
    documents: DataFrame, bibliography: Mapping[str, DataFrame], debug: bool = False
) -> DataFrame:
    """Add to every split the bibliography rows of its shards.

    A (split, year, month) without documents gets no bibliography either.
    """
    if debug:
        return documents
    present = documents.select(*SHARD).distinct()
    if _few(present):
        present = F.broadcast(present)
    rows = combine_splits(bibliography).join(present, list(SHARD), "left_semi")
    return union_sources(documents, rows.select(*documents.columns))


def _few(df: DataFrame, limit: int = 100_000) -> bool:
    return df.limit(limit + 1).count() <= limit


def blocks_of(
    documents: DataFrame,
    vocab: DataFrame,
    block: int = DEFAULT_BLOCK,
    tail: str = "keep",
    keep: Sequence[str] = (*SHARD, "doc_id"),
) -> DataFrame:
    """Tokenize and cut: one narrow stage from text to blocks."""
    return chunk_documents(tokenize(documents, vocab, keep=list(keep)), block, tail)


def shard_report(tokenized: DataFrame, block: int, by: Sequence[str] = SHARD, tail: str = "keep") -> DataFrame:
    """Papers, tokens, blocks, counted blocks and short tails of every shard.

    All follow from the lengths of the tokenized documents, so no block is made, and a document
    without tokens, or whose tail is dropped, is a paper like any other.
    """
    n = F.size("input_ids")
    rest = n % block
    padded, short = (2 * rest >= block) & (rest > 0), (2 * rest < block) & (rest > 0)
    counted = F.floor(n / block) + padded.cast("int")
    kept = short if tail == "keep" else F.lit(False)
    return tokenized.groupBy(*by).agg(
        F.count(F.lit(1)).alias("papers"),
        F.sum(n).alias("total_tokens"),
        F.sum(counted + kept.cast("int")).alias("blocks"),
        F.sum(counted).alias("counted_blocks"),
        F.count_if(kept).alias("short_tails"),
    )
