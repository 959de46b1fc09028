"""Batches, ranks, optimizer steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.operators import batching as b
from quillmill.operators import hooks, stats
from quillmill.operators.packing import chunk_documents
from quillmill.queries.base import (
    BLOCK,
    SPLIT,
    TOKENS,
    chunks_sql,
    documents,
    ids_sql,
    joined,
    query,
    split_documents,
    table,
    texts,
    tokenized,
)
from quillmill.session import materialize

ROWS = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents"
from quillmill.session import scratch_path


def _blocks(spark, sf):
    """Blocks are written before they are indexed: an index reads its keys more than once."""
    return materialize(chunk_documents(tokenized(spark, sf), BLOCK), "blocks")


def _ids(spark, sf):
    return table(spark, sf, "documents").select("doc_id")


@query(
    "sequential_batches",
    f"SELECT doc_id, pos // 32 AS batch_id, (pos % 32)::INT AS pos_in_batch FROM ({ROWS})",
)
def sequential_batches(spark, sf):
    return b.assign_batches(_ids(spark, sf), 32, ["doc_id"])


@query(
    "block_batches",
    f"""WITH {chunks_sql()}, r AS (SELECT doc_id, chunk_idx, real + missing AS len,
              row_number() OVER (ORDER BY doc_id, chunk_idx) - 1 AS pos FROM chunks)
        SELECT pos // 16 AS batch_id, count(*) AS n, sum(len)::BIGINT AS n_slots FROM r GROUP BY pos // 16""",
)
def block_batches(spark, sf):
    blocks = _blocks(spark, sf).select("doc_id", "chunk_idx", F.size("input_ids").alias("len"))
    batched = b.assign_batches(blocks, 16, ["doc_id", "chunk_idx"])
    return batched.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("n_slots"))


@query(
    "batches_per_split",
    f"""WITH {SPLIT}, r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS pos
                            FROM tagged)
        SELECT doc_id, split, pos // 8 AS batch_id, (pos % 8)::INT AS pos_in_batch FROM r""",
)
def batches_per_split(spark, sf):
    rows = split_documents(spark, sf).select("doc_id", "split")
    return b.assign_batches(rows, 8, ["doc_id"], by=["split"])


SHUFFLED = """SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42:{epoch}'), doc_id) - 1 AS pos,
                     count(*) OVER () AS n FROM documents"""


@query(
    "shuffled_batches",
    f"SELECT doc_id, pos // 32 AS batch_id, (pos % 32)::INT AS pos_in_batch FROM ({SHUFFLED.format(epoch=1)})",
)
def shuffled_batches(spark, sf):
    return b.shuffle_batches(_ids(spark, sf), 32, 42, 1, "doc_id")


@query(
    "shuffled_full_batches",
    f"""SELECT doc_id, pos // 48 AS batch_id, (pos % 48)::INT AS pos_in_batch FROM ({SHUFFLED.format(epoch=2)})
        WHERE (pos // 48 + 1) * 48 <= n""",
)
def shuffled_full_batches(spark, sf):
    return b.shuffle_batches(_ids(spark, sf), 48, 42, 2, "doc_id", drop_last=True)


@query(
    "length_grouped_batches",
    f"""WITH {TOKENS}, r AS (SELECT doc_id, len(tok) AS n_tokens,
              row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS rpos, count(*) OVER () AS n FROM toks),
        m AS (SELECT *, 16 * greatest(least(n // 64, 50), 1) AS rows FROM r),
        k AS (SELECT *, rpos // rows AS mega_id, row_number() OVER (PARTITION BY rpos // rows
              ORDER BY n_tokens DESC, rpos) - 1 AS rank FROM m),
        t AS (SELECT mega_id AS top FROM k WHERE rank = 0 ORDER BY n_tokens DESC, mega_id LIMIT 1),
        p AS (SELECT doc_id, mega_id, CASE WHEN rank = 0 AND mega_id = 0 THEN top * rows
              WHEN rank = 0 AND mega_id = top THEN 0 ELSE mega_id * rows + rank END AS pos FROM k, t)
        SELECT doc_id, mega_id, pos // 16 AS batch_id, (pos % 16)::INT AS pos_in_batch FROM p""",
)
def length_grouped_batches(spark, sf):
    rows = materialize(tokenized(spark, sf).select("doc_id", F.size("input_ids").alias("n_tokens")), "lengths")
    return b.length_grouped_batches(rows, 16, 42, "doc_id", "n_tokens").drop("n_tokens")


@query(
    "ranks_interleaved",
    f"SELECT ((pos // 16) % 7)::INT AS rank, count(*) AS n_rows, sum(doc_id)::BIGINT AS id_sum FROM ({ROWS}) GROUP BY 1",
)
def ranks_interleaved(spark, sf):
    batched = b.assign_batches(_ids(spark, sf), 16, ["doc_id"])
    return (
        b.shard_for_ranks(batched, 7)
        .groupBy("rank")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("doc_id").alias("id_sum"))
    )


@query(
    "ranks_contiguous",
    f"""WITH r AS ({ROWS}), s AS (SELECT *, ceil(n / 48.0)::BIGINT * 16 AS share FROM r),
        e AS (SELECT doc_id, pos, share, false AS is_padding FROM s
              UNION ALL SELECT doc_id, pos + n, share, true FROM s WHERE pos < share * 3 - n)
        SELECT doc_id, (pos // share)::INT AS rank, pos % share AS pos_in_rank, is_padding FROM e""",
)
def ranks_contiguous(spark, sf):
    return b.shard_for_ranks(_ids(spark, sf), 3, "contiguous", batch_size=16, order=["doc_id"])


@query(
    "resumed_batches",
    f"""WITH u AS (SELECT greatest((max(pos // 8) + 1) // 4, 1) AS upe FROM ({ROWS})),
        r AS ({ROWS}) SELECT doc_id, pos // 8 AS batch_id FROM r, u WHERE pos // 8 >= (100 % upe) * 4""",
)
def resumed_batches(spark, sf):
    rows = _ids(spark, sf)
    plan = stats.step_plan(rows, 8, 4, by=()).first()
    batched = b.assign_batches(rows, 8, ["doc_id"]).drop("pos_in_batch")
    return b.resume_from(batched, 100, plan["updates_per_epoch"], 4)


@query(
    "resumed_by_name",
    f"""WITH r AS ({ROWS}), nb AS (SELECT max(pos // 8) + 1 AS nb FROM r),
        c AS (SELECT 'step_30' AS checkpoint, (30 * 4) // nb AS epoch, (30 * 4) % nb AS skipped FROM nb
              UNION ALL SELECT 'runs/epoch_1.pt', 2, 0)
        SELECT checkpoint, epoch::INT AS epoch, doc_id, pos // 8 AS batch_id FROM r, c WHERE pos // 8 >= skipped""",
)
def resumed_by_name(spark, sf):
    path = scratch_path(spark, "batches")
    b.write_batches(b.assign_batches(_ids(spark, sf), 8, ["doc_id"]).select("doc_id", "batch_id"), path)
    step, epoch = (b.resume_batches(spark, path, name, 4).withColumn("checkpoint", F.lit(name)) for name in ("step_30", "runs/epoch_1.pt"))
    return step.unionByName(epoch).select("checkpoint", "epoch", "doc_id", "batch_id")


@query(
    "optimizer_steps",
    f"""WITH b AS (SELECT DISTINCT pos // 8 AS batch_id FROM ({ROWS})),
        e AS (SELECT e.epoch, batch_id FROM b, (VALUES (0), (1), (2)) e(epoch)),
        c AS (SELECT *, row_number() OVER (ORDER BY epoch, batch_id) AS seen,
                     count(*) OVER (PARTITION BY epoch) AS in_epoch,
                     max(batch_id) OVER (PARTITION BY epoch) AS last FROM e),
        f AS (SELECT *, seen % 6 = 0 OR (in_epoch <= 6 AND batch_id = last) AS is_update FROM c)
        SELECT epoch, batch_id, is_update, 1 + coalesce(sum(is_update::INT) OVER (ORDER BY epoch, batch_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS step FROM f""",
)
def optimizer_steps(spark, sf):
    batched = b.assign_batches(_ids(spark, sf), 8, ["doc_id"]).select("batch_id").distinct()
    epochs = batched.select(F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("epoch"), "batch_id")
    return b.assign_steps(epochs, 6)


@query(
    "collated_batches",
    f"""WITH {chunks_sql()}, r AS (SELECT list_resize(part, real + missing, 0) AS ids, real,
              row_number() OVER (ORDER BY doc_id, chunk_idx) - 1 AS pos FROM chunks),
        m AS (SELECT *, pos // 4 AS batch_id, max(len(ids)) OVER (PARTITION BY pos // 4) AS longest FROM r)
        SELECT batch_id, count(*)::INT AS n, string_agg(array_to_string(list_resize(ids, longest, 0), ' '), ' '
               ORDER BY pos) AS input_ids, sum(real)::BIGINT AS mask_sum FROM m GROUP BY batch_id""",
)
def collated_batches(spark, sf):
    batched = b.assign_batches(_blocks(spark, sf), 4, ["doc_id", "chunk_idx"])
    ones = F.aggregate(F.flatten("attention_mask"), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return b.collate(batched).select(
        "batch_id", "n", joined(F.flatten("input_ids")).alias("input_ids"), ones.alias("mask_sum")
    )


@query("num_examples", f"SELECT (max(pos // 32) + 1) * 32 AS estimated, max(n) AS num_examples FROM ({ROWS})")
def num_examples(spark, sf):
    batched = b.assign_batches(_ids(spark, sf), 32, ["doc_id"])
    estimated = stats.num_examples(batched, 32).select(F.col("num_examples").alias("estimated"))
    exact = stats.num_examples(_ids(spark, sf)).scalar()
    return estimated.select("estimated", exact.alias("num_examples"))


@query(
    "num_tokens_by_steps",
    f"""WITH {TOKENS}, r AS (SELECT len(tok) AS k, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM toks)
        SELECT sum(k)::BIGINT * 500 AS num_tokens FROM r WHERE pos // 16 = 0""",
)
def num_tokens_by_steps(spark, sf):
    return stats.num_tokens(b.assign_batches(tokenized(spark, sf), 16, ["doc_id"]), max_steps=500)


PLAN = f"""WITH {SPLIT}, c AS (SELECT year, month, count(*) AS n_examples FROM tagged GROUP BY year, month),
        b AS (SELECT *, ceil(n_examples / 4.0)::BIGINT AS n_batches FROM c)"""


@query(
    "step_plan",
    PLAN
    + """, u AS (SELECT *, greatest(n_batches // 4, 1) AS updates_per_epoch FROM b)
        SELECT year, month, n_examples, n_batches, updates_per_epoch,
               ceil(updates_per_epoch * 2.5::DOUBLE)::BIGINT AS total_steps, 3::BIGINT AS n_epochs,
               n_examples * 2.5::DOUBLE AS n_samples FROM u""",
)
def step_plan(spark, sf):
    return stats.step_plan(documents(spark, sf), 4, 4, epochs=2.5)


@query(
    "step_plan_rounded_up",
    PLAN
    + """, u AS (SELECT *, ceil(n_batches / 4.0)::BIGINT AS updates_per_epoch FROM b)
        SELECT year, month, n_examples, n_batches, updates_per_epoch, updates_per_epoch * 3 AS total_steps,
               3::BIGINT AS n_epochs, n_examples * 3::DOUBLE AS n_samples FROM u""",
)
def step_plan_rounded_up(spark, sf):
    return stats.step_plan(documents(spark, sf), 4, 4, epochs=3, rounding="ceil")


@query(
    "step_plan_max_steps",
    PLAN
    + """, u AS (SELECT *, greatest(n_batches // 4, 1) AS updates_per_epoch FROM b)
        SELECT year, month, n_examples, n_batches, updates_per_epoch, 100::BIGINT AS total_steps,
               ceil(100 / updates_per_epoch::DOUBLE)::BIGINT AS n_epochs, 1600::DOUBLE AS n_samples FROM u""",
)
def step_plan_max_steps(spark, sf):
    return stats.step_plan(documents(spark, sf), 4, 4, max_steps=100)


@query(
    "tokens_seen",
    f"""WITH {TOKENS}, r AS (SELECT len(tok) AS k, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS step FROM toks),
        s AS (SELECT step, sum(k)::BIGINT AS n_tokens FROM r GROUP BY step)
        SELECT step, n_tokens, sum(n_tokens) OVER (ORDER BY step)::BIGINT AS tokens_seen FROM s""",
)
def tokens_seen(spark, sf):
    rows = tokenized(spark, sf).select("doc_id", F.size("input_ids").alias("k"))
    steps = (
        b.assign_batches(rows, 8, ["doc_id"])
        .groupBy(F.col("batch_id").alias("step"))
        .agg(F.sum("k").alias("n_tokens"))
    )
    return stats.tokens_seen(materialize(steps, "steps"), ["step"])


@query(
    "map_batches",
    f"WITH {TOKENS} SELECT doc_id, len(tok)::BIGINT AS n_words, tok[1] AS first_word FROM toks WHERE len(tok) > 0",
)
def map_batches(spark, sf):
    def words(batch):
        kept = [(i, t.split()) for i, t in zip(batch["doc_id"], batch["text"]) if t.split()]
        return {
            "doc_id": [i for i, _ in kept],
            "n_words": [len(w) for _, w in kept],
            "first_word": [w[0] for _, w in kept],
        }

    rows = texts(spark, sf).select("doc_id", "text")
    return hooks.map_batches(
        rows, words, "doc_id long, n_words long, first_word string", batch_size=64, remove_columns=["text"]
    )


@query(
    "custom_collate",
    f"""WITH {ids_sql()}, r AS (SELECT len(ids) AS k, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch_id FROM ids)
        SELECT batch_id, count(*) AS n, max(k)::BIGINT AS longest,
               (max(k) * count(*) - sum(k))::BIGINT AS n_pads FROM r GROUP BY batch_id""",
)
def custom_collate(spark, sf):
    import pandas as pd

    def shape(frame):
        sizes = frame["input_ids"].map(len)
        longest = int(sizes.max())
        row = {"n": len(frame), "longest": longest, "n_pads": longest * len(frame) - int(sizes.sum())}
        return pd.DataFrame([{"batch_id": int(frame["batch_id"].iloc[0]), **row}])

    batched = b.assign_batches(tokenized(spark, sf).drop("attention_mask"), 16, ["doc_id"])
    return hooks.collate_with(batched, shape, "batch_id long, n long, longest long, n_pads long")
