"""Vocabulary and tokenization."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.operators import tokenization as t
from quillmill.operators import vocab as v
from quillmill.operators.batching import padded_batches
from quillmill.queries.base import SPECIALS, TOKENS, ids_sql, joined, query, texts, tokenized, vocab_sql, vocabulary


@query("vocabulary", f"WITH {vocab_sql()} SELECT token, id::INT AS id, n FROM built WHERE id < 30007")
def vocabulary_table(spark, sf):
    return v.build_vocab(texts(spark, sf))


@query(
    "special_tokens_appended",
    f"""WITH {TOKENS}, specials(token, o) AS (VALUES {SPECIALS}),
        freq AS (SELECT token, count(*) AS n FROM (SELECT unnest(tok) AS token FROM toks) GROUP BY token),
        b AS (SELECT token, (row_number() OVER (ORDER BY n DESC, token) - 1) AS id FROM freq),
        top AS (SELECT * FROM b WHERE id < 2000)
        SELECT token, id::INT AS id FROM top
        UNION ALL SELECT token, (SELECT max(id) FROM top)::INT + 1 + o FROM specials""",
)
def special_tokens_appended(spark, sf):
    plain = v.build_vocab(texts(spark, sf), size=2000, first_id=0)
    return v.with_special_tokens(plain)


@query(
    "tokenize",
    f"""WITH {ids_sql()} SELECT doc_id, array_to_string(ids, ' ') AS input_ids, len(ids)::INT AS mask_sum FROM ids""",
)
def tokenize(spark, sf):
    rows = tokenized(spark, sf)
    mask = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return rows.select("doc_id", joined("input_ids").alias("input_ids"), mask.alias("mask_sum"))


@query(
    "tokenize_small_vocabulary",
    f"""WITH {ids_sql(500)} SELECT doc_id, array_to_string(ids, ' ') AS input_ids,
        len(list_filter(ids, lambda x: x = 4))::INT AS n_unknown FROM ids""",
)
def tokenize_small_vocabulary(spark, sf):
    rows = tokenized(spark, sf, size=500)
    unknown = F.size(F.filter("input_ids", lambda x: x == v.UNK_ID))
    return rows.select("doc_id", joined("input_ids").alias("input_ids"), unknown.alias("n_unknown"))


@query(
    "tokenize_by_join",
    f"WITH {ids_sql()} SELECT doc_id, array_to_string(ids, ' ') AS input_ids FROM ids",
)
def tokenize_by_join(spark, sf):
    """The way taken by vocabularies too large to ship."""
    rows = texts(spark, sf).select("doc_id", "text")
    out = t.tokenize(rows, vocabulary(spark, sf), max_shipped=0)
    return out.select("doc_id", joined("input_ids").alias("input_ids"))


@query(
    "tokenize_padded",
    f"""WITH {ids_sql()},
        b AS (SELECT doc_id, ids[1:256] AS ids, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch_id FROM ids),
        m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM b)
        SELECT doc_id, batch_id, array_to_string(list_resize(ids, longest, 0), ' ') AS input_ids,
               array_to_string(list_resize(list_transform(ids, lambda x: 1), longest, 0), ' ') AS attention_mask
        FROM m""",
)
def tokenize_padded(spark, sf):
    rows = texts(spark, sf).select("doc_id", "text")
    out = padded_batches(rows, vocabulary(spark, sf), 256, 8, ["doc_id"])
    return out.select(
        "doc_id", "batch_id", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )


@query(
    "decode",
    f"""WITH {vocab_sql(2000)}, flat AS (SELECT doc_id, unnest(tok) AS token, generate_subscripts(tok, 1) AS pos
                 FROM toks)
        SELECT doc_id, coalesce(text, '') AS text FROM toks LEFT JOIN
           (SELECT doc_id, string_agg(CASE WHEN v.id IS NULL THEN '<unk>' ELSE flat.token END, ' ' ORDER BY pos) AS text
            FROM flat LEFT JOIN vocab v USING (token) GROUP BY doc_id) USING (doc_id)""",
)
def decode(spark, sf):
    ids = tokenized(spark, sf, size=2000)
    return t.decode(ids, vocabulary(spark, sf, 2000)).select("doc_id", "text")


@query("token_lengths", f"WITH {TOKENS} SELECT doc_id, len(tok)::INT AS n_tokens FROM toks")
def token_lengths(spark, sf):
    return t.token_lengths(tokenized(spark, sf)).select("doc_id", "n_tokens")
