"""The query registry, the inputs queries share, and their SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators import ordering as o
from quillmill.operators.splits import head_fraction_split
from quillmill.operators.tokenization import tokenize
from quillmill.operators.vocab import build_vocab, with_reserved_specials
from quillmill.schemas import VOCAB
from quillmill.session import scratch_path
from quillmill.sources.datasets import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BLOCK = 128


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def joined(ids: str | Column) -> Column:
    """An id array as text, which compares the same way in every engine."""
    column = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(column.cast("array<string>"), " ")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work on their text, on all cores."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the shard they belong to."""
    return texts(spark, sf_dir).select(
        "doc_id",
        "text",
        "lang",
        "source",
        (F.col("doc_id") % 4).cast("int").alias("year"),
        (F.floor(F.col("doc_id") / 4) % 12 + 1).cast("int").alias("month"),
    )


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return head_fraction_split(docs, {"val": 0.25, "test": 0.25}, ["doc_id"], rest="train")


_built: dict[tuple[str, str, int], str] = {}


def vocabulary(spark: SparkSession, sf_dir: str, size: int = 30_000) -> DataFrame:
    """The tokenizer asset of these queries: built and written once per session and input.

    A tokenizer is made ahead of the work that uses it; the query ``vocabulary``
    covers the making.
    """
    made = (spark.sparkContext.applicationId, sf_dir, size)
    if made not in _built:
        path = scratch_path(spark, "vocabulary")
        with_reserved_specials(build_vocab(texts(spark, sf_dir), size)).write.parquet(path)
        _built[made] = path
    return spark.read.schema(VOCAB).parquet(_built[made])


def tokenized(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None, size: int = 30_000) -> DataFrame:
    """doc_id (and the other columns of ``docs``), input_ids, attention_mask."""
    rows = texts(spark, sf_dir).select("doc_id", "text") if docs is None else docs
    return tokenize(rows, vocabulary(spark, sf_dir, size))


def run_log(spark: SparkSession, sf_dir: str, with_nan: bool = False) -> DataFrame:
    """Events as the log of many runs: run_id, step (1, 2, ...), loss, ts."""
    events = table(spark, sf_dir, "events")
    loss = F.col("value")
    if with_nan:
        loss = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(loss)
    rows = events.select("event_id", F.col("user_id").alias("run_id"), loss.alias("loss"), "ts")
    indexed = o.row_index(rows, ["event_id"], ["run_id"], "step")
    return indexed.withColumn("step", F.col("step") + 1)


# ---- SQL fragments: common table expressions, each usable after the ones above it

DOCS = """
docs AS (SELECT doc_id, text, lang, source, (doc_id % 4)::INT AS year,
                (1 + (doc_id // 4) % 12)::INT AS month FROM documents)"""

SPLIT = (
    DOCS
    + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY year, month ORDER BY doc_id) - 1 AS pos,
                  count(*) OVER (PARTITION BY year, month) AS n FROM docs),
tagged AS (SELECT * EXCLUDE (pos, n),
                  CASE WHEN pos < floor(n * 0.25::DOUBLE) THEN 'val'
                       WHEN pos < floor(n * 0.25::DOUBLE) + floor(n * 0.25::DOUBLE) THEN 'test'
                       ELSE 'train' END AS split FROM ranked)"""
)

TOKENS = r"""
toks AS (SELECT doc_id, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS tok FROM documents)"""

SPECIALS = "('<pad>', 0), ('<cls>', 1), ('<sep>', 2), ('<mask>', 3), ('<unk>', 4), ('<bos>', 5), ('<eos>', 6)"


def vocab_sql(size: int = 30_000) -> str:
    return (
        TOKENS
        + f""",
specials(token, id) AS (VALUES {SPECIALS}),
freq AS (SELECT token, count(*) AS n FROM (SELECT unnest(tok) AS token FROM toks)
         WHERE token NOT IN (SELECT token FROM specials) GROUP BY token),
built AS (SELECT token, n, 6 + row_number() OVER (ORDER BY n DESC, token) AS id FROM freq),
vocab AS (SELECT token, id FROM specials UNION ALL SELECT token, id FROM built WHERE id < 7 + {size})"""
    )


def ids_sql(size: int = 30_000) -> str:
    """... plus ids(doc_id, ids): the id list of every document."""
    return (
        vocab_sql(size)
        + """,
flat AS (SELECT doc_id, unnest(tok) AS token, generate_subscripts(tok, 1) AS pos FROM toks),
listed AS (SELECT doc_id, list(coalesce(v.id, 4)::INT ORDER BY pos) AS ids
           FROM flat LEFT JOIN vocab v USING (token) GROUP BY doc_id),
ids AS (SELECT doc_id, coalesce(ids, []::INT[]) AS ids FROM toks LEFT JOIN listed USING (doc_id))"""
    )


def chunks_sql(block: int = BLOCK, size: int = 30_000) -> str:
    """... plus chunks(doc_id, chunk_idx, ids, real, missing, num_chunks), short tails kept."""
    b = block
    return (
        ids_sql(size)
        + f""",
sized AS (SELECT doc_id, ids, len(ids) AS n FROM ids WHERE len(ids) > 0),
starts AS (SELECT *, unnest(range(0, n, {b})) AS st FROM sized),
cut AS (SELECT doc_id, (st // {b})::INT AS chunk_idx, n, ids[st + 1 : least(st + {b}, n)] AS part,
               least({b}, n - st) AS real FROM starts),
chunks AS (SELECT doc_id, chunk_idx, part, real::INT AS real,
                  (CASE WHEN 2 * real >= {b} THEN {b} - real ELSE 0 END)::INT AS missing,
                  (CASE WHEN chunk_idx > 0 THEN -1
                        ELSE n // {b} + CASE WHEN n % {b} <> 0 AND 2 * (n % {b}) >= {b} THEN 1 ELSE 0 END
                   END)::INT AS num_chunks FROM cut)"""
    )


def rounded_sql(value: str, places: int) -> str:
    """Python's rounding of a double, as ``round_binary`` does it."""
    s, d = f"{2 * 10**places}.0::DOUBLE", f"{10**places}.0::DOUBLE"
    half = f"round_even(({value}) * {s}, 0)"
    head = f"({value})::FLOAT::DOUBLE"
    rest = f"(({head} * {s} - {half}) + (({value}) - {head}) * {s})"
    return f"""(CASE WHEN {half} % 2 = 0 THEN {half} / 2 WHEN {rest} > 0 THEN ({half} + 1) / 2
        WHEN {rest} < 0 THEN ({half} - 1) / 2 WHEN (({half} - 1) / 2) % 2 = 0 THEN ({half} - 1) / 2
        ELSE ({half} + 1) / 2 END / {d})"""


# run_log(run_id, step, loss, ts); `nan` variant with missing losses
def runs_sql(with_nan: bool = False) -> str:
    loss = "CASE WHEN event_id % 97 = 0 THEN 'nan'::DOUBLE ELSE value END" if with_nan else "value"
    return f"""
runs AS (SELECT event_id, user_id AS run_id, {loss} AS loss, ts,
                row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM events)"""
