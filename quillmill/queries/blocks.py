"""Fixed-length blocks and the statistics of their shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.operators import packing as p
from quillmill.operators import stats
from quillmill.operators.combine import union_sources
from quillmill.operators.tokenization import tokenize
from quillmill.plans.corpus import shard_report, with_bibliography
from quillmill.queries.base import (
    BLOCK,
    SPLIT,
    TOKENS,
    chunks_sql,
    ids_sql,
    joined,
    query,
    split_documents,
    table,
    texts,
    tokenized,
    vocabulary,
)

@query(
    "chunk_documents",
    f"""WITH {chunks_sql()} SELECT doc_id, chunk_idx, num_chunks,
        array_to_string(list_resize(part, real + missing, 0), ' ') AS input_ids,
        array_to_string(list_resize(list_transform(part, lambda x: 1), real + missing, 0), ' ') AS attention_mask
        FROM chunks""",
)
def chunk_documents(spark, sf):
    out = p.chunk_documents(tokenized(spark, sf), BLOCK)
    return out.select(
        "doc_id",
        "chunk_idx",
        "num_chunks",
        joined("input_ids").alias("input_ids"),
        joined("attention_mask").alias("attention_mask"),
    )


@query(
    "chunk_documents_dropped_tail",
    f"""WITH {chunks_sql()} SELECT doc_id, chunk_idx, num_chunks,
        array_to_string(list_resize(part, real + missing, 0), ' ') AS input_ids
        FROM chunks WHERE real + missing = {BLOCK}""",
)
def chunk_documents_dropped_tail(spark, sf):
    out = p.chunk_documents(tokenized(spark, sf), BLOCK, tail="drop")
    return out.select("doc_id", "chunk_idx", "num_chunks", joined("input_ids").alias("input_ids"))


@query(
    "chunk_documents_mask_filler",
    f"""WITH {chunks_sql()} SELECT doc_id, chunk_idx,
        array_to_string(list_resize(part, real + missing, 3), ' ') AS input_ids,
        array_to_string(list_resize(list_transform(part, lambda x: 1), real + missing, 3), ' ') AS attention_mask
        FROM chunks""",
)
def chunk_documents_mask_filler(spark, sf):
    """The pad id in every column, as a pad id other than 0 shows."""
    out = p.chunk_documents(tokenized(spark, sf), BLOCK, pad_id=3, mask_pad=3, mark_count=False)
    return out.select(
        "doc_id", "chunk_idx", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )


@query(
    "block_counts",
    f"""WITH {chunks_sql()} SELECT doc_id, max(num_chunks)::INT AS num_chunks, count(*) AS n_blocks,
        sum(real)::BIGINT AS n_tokens FROM chunks GROUP BY doc_id""",
)
def block_counts(spark, sf):
    out = p.chunk_documents(tokenized(spark, sf), BLOCK)
    real = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return out.groupBy("doc_id").agg(
        F.max("num_chunks").alias("num_chunks"), F.count(F.lit(1)).alias("n_blocks"), F.sum(real).alias("n_tokens")
    )


PACKED = """
grouped AS (SELECT doc_id, ids, pos // {group} AS group_id FROM
            (SELECT doc_id, ids, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM ids)),
spots AS (SELECT group_id, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS spot FROM grouped),
streamed AS (SELECT group_id, id, row_number() OVER (PARTITION BY group_id ORDER BY doc_id, spot) - 1 AS off FROM spots),
packed AS (SELECT group_id, off // {block} AS block_id, list(id ORDER BY off) AS ids FROM streamed
           GROUP BY group_id, off // {block} HAVING count(*) = {block})"""


@query(
    "pack_batches",
    f"""WITH {ids_sql()}, {PACKED.format(group=1000, block=BLOCK)}
        SELECT group_id, block_id, array_to_string(ids, ' ') AS input_ids, array_to_string(ids, ' ') AS labels
        FROM packed""",
)
def pack_batches(spark, sf):
    out = p.pack_batches(tokenized(spark, sf), BLOCK, ["doc_id"])
    return out.select("group_id", "block_id", joined("input_ids").alias("input_ids"), joined("labels").alias("labels"))


@query(
    "pack_small_batches",
    f"""WITH {ids_sql()}, {PACKED.format(group=50, block=64)}
        SELECT group_id, block_id, array_to_string(ids, ' ') AS input_ids FROM packed""",
)
def pack_small_batches(spark, sf):
    out = p.pack_batches(tokenized(spark, sf), 64, ["doc_id"], group_size=50)
    return out.select("group_id", "block_id", joined("input_ids").alias("input_ids"))


@query(
    "pack_parallel_columns",
    f"""WITH {ids_sql()}, {PACKED.format(group=100, block=BLOCK)}
        SELECT group_id, block_id, array_to_string(ids, ' ') AS input_ids,
               array_to_string(list_transform(ids, lambda x: x % 2), ' ') AS token_type_ids FROM packed""",
)
def pack_parallel_columns(spark, sf):
    rows = tokenized(spark, sf).withColumn("token_type_ids", F.transform("input_ids", lambda x: x % 2))
    columns = ("input_ids", "attention_mask", "token_type_ids")
    out = p.pack_batches(rows, BLOCK, ["doc_id"], 100, columns=columns)
    return out.select(
        "group_id", "block_id", joined("input_ids").alias("input_ids"), joined("token_type_ids").alias("token_type_ids")
    )


@query(
    "block_labels",
    f"""WITH {chunks_sql()} SELECT doc_id, chunk_idx,
        array_to_string(list_transform(list_resize(part, real + missing, 0),
                                       lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ' ') AS labels
        FROM chunks""",
)
def block_labels(spark, sf):
    out = p.with_labels(p.chunk_documents(tokenized(spark, sf), BLOCK), pad_id=0)
    return out.select("doc_id", "chunk_idx", joined("labels").alias("labels"))


@query(
    "corpus_stats",
    f"""WITH {SPLIT}, {TOKENS} SELECT split, year, month, count(*) AS papers, sum(len(tok))::BIGINT AS total_tokens
        FROM tagged JOIN toks USING (doc_id) GROUP BY split, year, month""",
)
def corpus_stats(spark, sf):
    docs = split_documents(spark, sf).select("split", "year", "month", "doc_id", "text")
    return stats.corpus_stats(tokenized(spark, sf, docs))


@query(
    "total_chunks",
    f"""WITH {SPLIT}, {chunks_sql()} SELECT split, sum(num_chunks)::BIGINT AS total_chunks
        FROM chunks JOIN tagged USING (doc_id) WHERE num_chunks <> -1 GROUP BY split""",
)
def total_chunks(spark, sf):
    docs = split_documents(spark, sf).select("split", "doc_id", "text")
    return stats.total_chunks(p.chunk_documents(tokenized(spark, sf, docs), BLOCK), ["split"])


@query(
    "shard_report",
    f"""WITH {SPLIT}, {chunks_sql()} SELECT split, year, month,
        count(DISTINCT doc_id) AS papers, coalesce(sum(real), 0)::BIGINT AS total_tokens, count(chunk_idx) AS blocks,
        coalesce(sum(greatest(num_chunks, 0)), 0)::BIGINT AS counted_blocks,
        count_if(real + missing < {BLOCK})::BIGINT AS short_tails
        FROM tagged LEFT JOIN chunks USING (doc_id) GROUP BY split, year, month""",
)
def shard_report_query(spark, sf):
    return shard_report(tokenized(spark, sf, split_documents(spark, sf)), BLOCK)


@query(
    "corpus_with_bibliography",
    f"""WITH {SPLIT}, w AS (SELECT split, year, month, text FROM tagged),
        present AS (SELECT DISTINCT split, year, month FROM w),
        bib AS (SELECT s.split, (item_id % 4)::INT AS year, (1 + item_id % 12)::INT AS month, text
                FROM benchmark, (VALUES ('train'), ('val'), ('test')) s(split)),
        allrows AS (SELECT * FROM w UNION ALL SELECT * FROM bib SEMI JOIN present USING (split, year, month)),
        c AS (SELECT split, len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS n FROM allrows)
        SELECT split, count(*) AS papers, sum(n)::BIGINT AS total_tokens,
               sum((n + {BLOCK} - 1) // {BLOCK})::BIGINT AS blocks FROM c GROUP BY split""",
)
def corpus_with_bibliography(spark, sf):
    """Every split of a shard gets the bibliography of the shard."""
    docs = split_documents(spark, sf).select("split", "year", "month", F.lit("tex").alias("kind"), "text")
    bib = table(spark, sf, "benchmark").select(
        (F.col("item_id") % 4).cast("int").alias("year"),
        (F.col("item_id") % 12 + 1).cast("int").alias("month"),
        F.lit("bbl").alias("kind"),
        "text",
    )
    corpus = with_bibliography(docs, {s: bib for s in ("train", "val", "test")})
    vocab = vocabulary(spark, sf)
    blocks = p.chunk_documents(tokenize(corpus, vocab, keep=["split"]), BLOCK)
    real = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return blocks.groupBy("split").agg(
        F.count_if(F.col("chunk_idx") == 0).alias("papers"),
        F.sum(real).alias("total_tokens"),
        F.count(F.lit(1)).alias("blocks"),
    )


@query(
    "second_text_source",
    f"""WITH allrows AS (SELECT 'doc' AS kind, text FROM documents UNION ALL SELECT role, text FROM conversations),
        c AS (SELECT kind, len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS n FROM allrows)
        SELECT kind, sum(n)::BIGINT AS total_tokens,
               sum((n + {BLOCK} - 1) // {BLOCK})::BIGINT AS blocks FROM c GROUP BY kind""",
)
def second_text_source(spark, sf):
    docs = texts(spark, sf).select(F.lit("doc").alias("kind"), "text")
    turns = table(spark, sf, "conversations").select(F.col("role").alias("kind"), "text")
    ids = tokenize(union_sources(docs, turns), vocabulary(spark, sf))
    blocks = p.chunk_documents(ids, BLOCK)
    real = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return blocks.groupBy("kind").agg(F.sum(real).alias("total_tokens"), F.count(F.lit(1)).alias("blocks"))


@query(
    "num_tokens",
    f"WITH {TOKENS} SELECT sum(len(tok))::BIGINT AS num_tokens FROM toks",
)
def num_tokens(spark, sf):
    return stats.num_tokens(tokenized(spark, sf))


@query(
    "total_flos",
    f"""WITH {TOKENS} SELECT lang, sum(len(tok))::DOUBLE * 6e6::DOUBLE AS total_flos
        FROM documents JOIN toks USING (doc_id) GROUP BY lang""",
)
def total_flos(spark, sf):
    docs = texts(spark, sf).select("doc_id", "lang", "text")
    return stats.total_flos(tokenized(spark, sf, docs), 6e6, ["lang"])


@query("table_size", "SELECT round(sum(octet_length(encode(text)))::DOUBLE / 1e6::DOUBLE, 6) AS size_mb FROM documents")
def table_size(spark, sf):
    size = stats.table_size(texts(spark, sf))
    return size.select(F.round("size_mb", 6).alias("size_mb"))
