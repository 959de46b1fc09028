"""Vocabulary tables: (token, id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.functions.columns import tokens_of

# The special tokens, in the order in which they get ids.
SPECIAL_TOKENS = ("<pad>", "<cls>", "<sep>", "<mask>", "<unk>", "<bos>", "<eos>")

PAD_ID = 0
UNK_ID = 4
FIRST_ID = len(SPECIAL_TOKENS)
DEFAULT_SIZE = 30_000


def special_tokens(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(t).alias("token"), F.lit(i).alias("id")) for i, t in enumerate(SPECIAL_TOKENS)])
    return spark.range(1).select(F.inline(rows))


def count_tokens(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Corpus frequency of every token. Map-side counts keep hot tokens small."""
    return (
        df.select(F.explode(tokens_of(F.col(text_col))).alias("token"))
        .where(~F.col("token").isin(*SPECIAL_TOKENS))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def build_vocab(df: DataFrame, size: int = DEFAULT_SIZE, text_col: str = "text", first_id: int = FIRST_ID) -> DataFrame:
    """The ``size`` most frequent tokens; ids by falling frequency, then by token.

    Ids below ``first_id`` stay free for the special tokens. The one-task
    numbering sees at most ``size`` rows.
    """
    top = count_tokens(df, text_col).orderBy(F.desc("n"), "token").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return top.select("token", (rank - 1 + first_id).cast("int").alias("id"), "n")


def with_reserved_specials(vocab: DataFrame) -> DataFrame:
    """Special tokens on the ids that :func:`build_vocab` left free for them."""
    return special_tokens(vocab.sparkSession).unionByName(vocab.select("token", "id"))


def with_special_tokens(vocab: DataFrame) -> DataFrame:
    """Register the special tokens in any vocabulary.

    A special token that the vocabulary already holds keeps its id; the others
    are appended after the largest id, in their fixed order.
    """
    plain = vocab.select("token", "id")
    missing = special_tokens(vocab.sparkSession).join(plain.select("token"), "token", "left_anti")
    last = plain.agg(F.max("id").alias("last")).select(F.coalesce("last", F.lit(-1))).scalar()
    rank = F.row_number().over(Window.orderBy("id"))
    return plain.unionByName(missing.select("token", (last + rank).cast("int").alias("id")))
