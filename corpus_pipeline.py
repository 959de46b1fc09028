"""Documents to mixed, deduplicated and tokenized training rows, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. run() writes what a stage keeps as Parquet in the shared folder
and reads it again, so that a lost executor never repeats more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.jaccard import keep_one_of_each
from quillmill.llm.lines import drop_boilerplate
from quillmill.llm.mixing import mix_documents
from quillmill.llm.quality import keep_good
from quillmill.llm.tokens import TOKENIZER, encode_documents
from quillmill.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; n_chars counts what is left."""
    rows = drop_boilerplate(docs.select(*COLUMNS)).select("record.*")
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word Jaccard similarity 0.8 stays."""
    return keep_one_of_each(docs.select(*COLUMNS), 5, 80, 100).select(*COLUMNS)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, in random order."""
    return mix_documents(docs.select(*COLUMNS), copy_col=None).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, exact): exact if the ids decode to the very text."""
    tagged = docs.select(F.struct("doc_id", "source", F.xxhash64("text").alias("h")).alias("key"), "text")
    coded = encode_documents(tagged, TOKENIZER, "key", "text")
    exact = F.xxhash64("decoded") == F.coalesce(F.col("id.h"), F.xxhash64(F.lit("")))
    return coded.select("id.doc_id", "id.source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mixture),
    ("BPE encoding and decoding", encoding),
]

#: SQL can't express the robust estimates nor the tokenizer; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
