"""Predictions, losses, perplexity and the pair model that feeds them."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import columns as c
from quillmill.operators import bigram, hooks
from quillmill.operators import metrics as m
from quillmill.plans.evaluation import batch_losses, evaluate, packed_blocks
from quillmill.queries.base import (
    SPLIT,
    ids_sql,
    joined,
    query,
    split_documents,
    table,
    texts,
    tokenized,
    vocabulary,
)
from quillmill.session import materialize

K = 0.1


def _split_ids(spark, sf):
    docs = split_documents(spark, sf).select("split", "year", "month", "lang", "doc_id", "text")
    return materialize(tokenized(spark, sf, docs), "split-ids", ("split",))


def _train(rows):
    return rows.where(F.col("split") == "train")


def _model(rows):
    return materialize(bigram.fit_bigram(_train(rows)), "pair-model")


def _val(rows):
    return rows.where(F.col("split") == "val")


PAIRS = (
    ids_sql()
    + f""", {SPLIT.strip()},
pairs AS (SELECT doc_id, split, year, month, lang, prev, next FROM
          (SELECT doc_id, unnest(ids[1 : len(ids) - 1]) AS prev, unnest(ids[2 : len(ids)]) AS next FROM ids
           WHERE len(ids) > 1) JOIN tagged USING (doc_id)),
model AS (SELECT prev, next, count(*) AS c FROM pairs WHERE split = 'train' GROUP BY prev, next),
totals AS (SELECT prev, sum(c)::BIGINT AS total FROM model GROUP BY prev),
best AS (SELECT prev, next AS predicted, c AS support FROM model
         QUALIFY row_number() OVER (PARTITION BY prev ORDER BY c DESC, next) = 1),
scored AS (SELECT p.*, -ln((coalesce(c, 0) + {K}::DOUBLE) / (coalesce(total, 0) + {K}::DOUBLE * (SELECT count(*) FROM vocab))) AS loss
           FROM pairs p LEFT JOIN model USING (prev, next) LEFT JOIN totals USING (prev))"""
)


@query("bigram_model", f"WITH {PAIRS} SELECT prev, next, c FROM model")
def bigram_model(spark, sf):
    return bigram.fit_bigram(_train(_split_ids(spark, sf)))


@query("next_token", f"WITH {PAIRS} SELECT prev, predicted, support FROM best")
def next_token(spark, sf):
    return bigram.predict_next(bigram.fit_bigram(_train(_split_ids(spark, sf))))


@query(
    "next_token_hits",
    f"""WITH {PAIRS} SELECT lang, count(*) AS n_pairs, count_if(predicted = next)::BIGINT AS n_hits
        FROM pairs LEFT JOIN best USING (prev) WHERE split = 'val' GROUP BY lang""",
)
def next_token_hits(spark, sf):
    rows = _split_ids(spark, sf)
    return bigram.prediction_hits(
        bigram.count_pairs(_val(rows), ["lang"]), _model(rows), ["lang"]
    )


@query(
    "shard_perplexity",
    f"""WITH {PAIRS} SELECT year, month, count(*) AS n_pairs, round(avg(loss), 6) AS mean_loss,
        round(exp(avg(loss)), 4) AS perplexity FROM scored WHERE split = 'val' GROUP BY year, month""",
)
def shard_perplexity(spark, sf):
    rows = _split_ids(spark, sf)
    by = ["year", "month"]
    out = bigram.score_shards(bigram.count_pairs(_val(rows), by), _model(rows), K, vocabulary(spark, sf).count(), by)
    return out.select(
        *by, "n_pairs", F.round("mean_loss", 6).alias("mean_loss"), F.round("perplexity", 4).alias("perplexity")
    )


@query(
    "document_losses",
    f"""WITH {PAIRS} SELECT doc_id, count(*) AS n_pairs, round(avg(loss), 6) AS loss FROM scored
        WHERE split <> 'train' GROUP BY doc_id""",
)
def document_losses(spark, sf):
    rows = _split_ids(spark, sf)
    evaluated = rows.where(F.col("split") != "train")
    out = bigram.score_rows(evaluated, _model(rows), K, vocabulary(spark, sf).count(), ["doc_id"])
    return out.select("doc_id", "n_pairs", F.round("loss", 6).alias("loss"))


@query(
    "curriculum",
    f"""WITH {PAIRS},
        p AS (SELECT split, year * 100 + month AS s, prev, next FROM pairs WHERE split IN ('train', 'val')),
        delta AS (SELECT s, prev, next, count_if(split = 'train') AS added, count_if(split = 'val') AS c
                  FROM p GROUP BY s, prev, next),
        seen AS (SELECT *, sum(added) OVER (PARTITION BY prev, next ORDER BY s) AS seen FROM delta),
        tok AS (SELECT s, prev, sum(sum(added)) OVER (PARTITION BY prev ORDER BY s) AS total
                FROM delta GROUP BY s, prev),
        l AS (SELECT s, c, -ln((seen + {K}::DOUBLE) / (total + {K}::DOUBLE * (SELECT count(*) FROM vocab))) AS loss
              FROM seen JOIN tok USING (s, prev) WHERE c > 0)
        SELECT (s // 100)::INT AS year, (s % 100)::INT AS month, sum(c)::BIGINT AS n_pairs,
               round(sum(c * loss) / sum(c), 6) AS mean_loss FROM l GROUP BY s""",
)
def curriculum(spark, sf):
    out = bigram.curriculum(_split_ids(spark, sf), K, vocabulary(spark, sf).count())
    return out.select("year", "month", "n_pairs", F.round("mean_loss", 6).alias("mean_loss"))


@query(
    "token_accuracy",
    f"""WITH {PAIRS} SELECT split, count_if(coalesce(predicted, -1) = next)::BIGINT AS n_hits,
        count(*) AS n_predictions, round(count_if(coalesce(predicted, -1) = next) / count(*), 6) AS accuracy
        FROM pairs LEFT JOIN best USING (prev) GROUP BY split""",
)
def token_accuracy(spark, sf):
    rows = _split_ids(spark, sf)
    predicted = bigram.predict_rows(rows, _model(rows))
    out = m.token_accuracy(predicted, ["split"], labels="input_ids")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "token_accuracy_masked",
    f"""WITH {PAIRS} SELECT lang, count_if(coalesce(predicted, -1) = next AND next % 5 <> 0)::BIGINT AS n_hits,
        count_if(next % 5 <> 0)::BIGINT AS n_predictions FROM pairs LEFT JOIN best USING (prev) GROUP BY lang""",
)
def token_accuracy_masked(spark, sf):
    rows = _split_ids(spark, sf)
    predicted = bigram.predict_rows(rows, _model(rows))
    masked = predicted.withColumn("labels", F.transform("input_ids", lambda x: F.when(x % 5 == 0, -100).otherwise(x)))
    return m.token_accuracy(masked, ["lang"], mask=True).select("lang", "n_hits", "n_predictions")


@query(
    "argmax_tokens",
    "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS pred FROM embeddings",
)
def argmax_tokens(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", c.argmax_token(F.col("embedding")).alias("pred"))


@query(
    "logits_hook",
    """SELECT label, count_if(list_position(embedding, list_max(embedding)) - 1 = label)::BIGINT AS n_right,
              count(*) AS n FROM embeddings GROUP BY label""",
)
def logits_hook(spark, sf):
    reduced = hooks.apply_logits_hook(table(spark, sf, "embeddings"), c.argmax_token, "embedding", "preds")
    right = F.count_if(F.col("preds") == F.col("label")).alias("n_right")
    return reduced.groupBy("label").agg(right, F.count(F.lit(1)).alias("n"))


@query(
    "scored_logits",
    """SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS pred,
              round(ln(list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE)))) - embedding[label + 1]::DOUBLE, 6)
              AS loss FROM embeddings""",
)
def scored_logits(spark, sf):
    def load():
        import numpy as np
        import pandas as pd

        def predict(frame):
            logits = np.stack(frame["embedding"].to_numpy()).astype("float64")
            right = logits[np.arange(len(frame)), frame["label"].to_numpy()]
            loss = np.log(np.exp(logits).sum(axis=1)) - right
            return pd.DataFrame({"pred": logits.argmax(axis=1), "loss": loss})

        return predict

    rows = table(spark, sf, "embeddings")
    out = m.score(rows, load, ["embedding", "label"], {"pred": "int", "loss": "double"}, keep=["vec_id"])
    return out.withColumn("loss", F.round("loss", 6))


# eval records: one per user and day, losses of known size
RECORDS = """records AS (SELECT event_type AS dataset, user_id AS batch_id, count(*) AS n, avg(value) / 100 AS loss
                         FROM events GROUP BY event_type, user_id)"""


def _records(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("dataset"), F.col("user_id").alias("batch_id"))
        .agg(F.count(F.lit(1)).alias("n"), (F.avg("value") / 100).alias("loss"))
    )


@query("mean_loss_by_batch", f"WITH {RECORDS} SELECT round(avg(loss), 6) AS mean_loss, count(*) AS n_batches FROM records")
def mean_loss_by_batch(spark, sf):
    return m.mean_loss(_records(spark, sf)).withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "mean_loss_by_sample",
    f"""WITH {RECORDS} SELECT dataset, round(sum(loss * n) / sum(n), 6) AS mean_loss, count(*) AS n_batches
        FROM records GROUP BY dataset""",
)
def mean_loss_by_sample(spark, sf):
    return m.mean_loss(_records(spark, sf), ["dataset"], "sample").withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "mean_loss_gathered",
    f"""WITH {RECORDS} SELECT dataset, round(sum(loss * least(n, 16)) / sum(least(n, 16)), 6) AS mean_loss,
        count(*) AS n_batches FROM records GROUP BY dataset""",
)
def mean_loss_gathered(spark, sf):
    out = m.mean_loss(_records(spark, sf), ["dataset"], "gathered", 16)
    return out.withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "perplexity",
    f"""WITH {RECORDS}, x AS (SELECT dataset, avg(loss) AS l FROM records GROUP BY dataset)
        SELECT dataset, round(l, 6) AS mean_loss, round(exp(l), 6) AS perplexity FROM x
        UNION ALL SELECT dataset || '-diverged', round(l * 2000, 6), 'inf'::DOUBLE FROM x""",
)
def perplexity(spark, sf):
    means = m.mean_loss(_records(spark, sf), ["dataset"]).drop("n_batches")
    diverged = means.select(
        F.concat("dataset", F.lit("-diverged")).alias("dataset"), (F.col("mean_loss") * 2000).alias("mean_loss")
    )
    out = m.perplexity(means.unionByName(diverged))
    return out.select(
        "dataset",
        F.round("mean_loss", 6).alias("mean_loss"),
        # rounding would turn infinity into null
        F.when(c.is_inf(F.col("perplexity")), F.col("perplexity")).otherwise(F.round("perplexity", 6)).alias("perplexity"),
    )


@query(
    "evaluate_many",
    f"""WITH {RECORDS}, g AS (SELECT dataset, avg(loss) AS l, sum(n)::DOUBLE AS n FROM records GROUP BY dataset)
        SELECT 'eval_' || dataset || '_loss' AS metric, round(l, 6) AS value FROM g
        UNION ALL SELECT 'eval_' || dataset || '_perplexity', round(exp(l), 6) FROM g
        UNION ALL SELECT 'eval_' || dataset || '_samples', n FROM g""",
)
def evaluate_many(spark, sf):
    return m.evaluate_many(_records(spark, sf)).withColumn("value", F.round("value", 6))


@query("sample_count", f"WITH {RECORDS} SELECT sum(n)::BIGINT AS num_samples FROM records")
def sample_count(spark, sf):
    return m.sample_count(_records(spark, sf))


@query(
    "speed_metrics",
    """WITH r AS (SELECT event_type AS dataset, count(*) AS num_samples, sum(value)::DOUBLE AS v FROM events
                  GROUP BY event_type), q AS (SELECT *, round(v, 2) / 1000 AS runtime FROM r)
       SELECT dataset, num_samples, round(runtime, 4) AS eval_runtime,
              round(num_samples / runtime, 3) AS eval_samples_per_second,
              round(ceil(num_samples / 8.0) / runtime, 3) AS eval_steps_per_second FROM q""",
)
def speed_metrics(spark, sf):
    rows = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("dataset"))
        .agg(F.count(F.lit(1)).alias("num_samples"), (F.round(F.sum("value"), 2) / 1000).alias("runtime"))
    )
    return m.speed_metrics(rows, 8).drop("runtime")


@query(
    "padded_predictions",
    f"""WITH {ids_sql()}, w AS (SELECT max(len(ids)) AS longest FROM ids)
        SELECT doc_id, longest::INT AS n, (longest - len(ids))::INT AS n_fillers,
               md5(array_to_string(list_resize(ids, longest, -100), ' ')) AS preds_md5 FROM ids, w""",
)
def padded_predictions(spark, sf):
    rows = tokenized(spark, sf).select("doc_id", F.col("input_ids").alias("preds"))
    return m.pad_predictions(rows).select(
        "doc_id",
        F.size("preds").alias("n"),
        F.size(F.filter("preds", lambda x: x == c.IGNORE_INDEX)).alias("n_fillers"),
        F.md5(joined("preds")).alias("preds_md5"),
    )


@query(
    "metric_hook",
    f"""WITH {PAIRS} SELECT doc_id, round(count_if(coalesce(predicted, -1) = next) / count(*), 6) AS accuracy
        FROM pairs LEFT JOIN best USING (prev) WHERE split = 'val' GROUP BY doc_id""",
)
def metric_hook(spark, sf):
    def accuracy(preds, labels):
        right = sum((p[:-1] == l[1:]).sum() for p, l in zip(preds, labels))
        return {"accuracy": right / sum(len(l) - 1 for l in labels)}

    rows = _split_ids(spark, sf)
    predicted = bigram.predict_rows(_val(rows).where(F.size("input_ids") > 1), _model(rows))
    out = hooks.apply_metric(predicted, accuracy, ["accuracy"], ["doc_id"], labels="input_ids")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "metric_hook_by_split",
    f"""WITH {PAIRS} SELECT split, round(count_if(coalesce(predicted, -1) = next) / count(*), 6) AS accuracy,
        count(DISTINCT next)::DOUBLE AS n_tokens FROM pairs LEFT JOIN best USING (prev) GROUP BY split""",
)
def metric_hook_by_split(spark, sf):
    """One split is one group: states of (hits, pairs, tokens seen) are merged, no group meets in a task."""

    def update(state, preds, labels):
        hits, n, seen = state
        for p, l in zip(preds, labels):
            hits += int((p[:-1] == l[1:]).sum())
            n += len(l) - 1
            seen.update(l[1:].tolist())
        return hits, n, seen

    metric = hooks.MergeableMetric(
        zero=lambda: (0, 0, set()),
        update=update,
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] | b[2]),
        finish=lambda s: {"accuracy": s[0] / max(s[1], 1), "n_tokens": len(s[2])},
    )
    rows = _split_ids(spark, sf)
    predicted = bigram.predict_rows(rows.where(F.size("input_ids") > 1), _model(rows))
    out = hooks.apply_mergeable_metric(predicted, metric, ["accuracy", "n_tokens"], ["split"], labels="input_ids")
    return out.withColumn("accuracy", F.round("accuracy", 6))


EVAL_FLOW = (
    ids_sql()
    + f""",
r AS (SELECT doc_id, ids, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM ids),
s AS (SELECT doc_id, ids, CASE WHEN r <= round_even(n * 5.0::DOUBLE / 100, 0) THEN 'validation' ELSE 'train' END AS split
      FROM r),
g AS (SELECT split, (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) // 1000 AS group_id, doc_id, ids FROM s),
sp AS (SELECT split, group_id, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS spot FROM g),
st AS (SELECT split, group_id, id, row_number() OVER (PARTITION BY split, group_id ORDER BY doc_id, spot) - 1 AS off FROM sp),
bl AS (SELECT split, group_id, off // 128 AS block_id, list(id ORDER BY off) AS ids FROM st
       GROUP BY split, group_id, off // 128 HAVING count(*) = 128),
bp AS (SELECT split, group_id, block_id, unnest(ids[1:127]) AS prev, unnest(ids[2:128]) AS next FROM bl),
model AS (SELECT prev, next, count(*) AS c FROM bp WHERE split = 'train' GROUP BY prev, next),
totals AS (SELECT prev, sum(c)::BIGINT AS total FROM model GROUP BY prev),
ev AS (SELECT group_id, block_id, (row_number() OVER (ORDER BY group_id, block_id) - 1) // 8 AS batch_id
       FROM bl WHERE split = 'validation'),
losses AS (SELECT batch_id, avg(-ln((coalesce(c, 0) + {K}::DOUBLE) / (coalesce(total, 0) + {K}::DOUBLE * (SELECT count(*) FROM vocab)))) AS loss
       FROM bp JOIN ev USING (group_id, block_id) LEFT JOIN model USING (prev, next) LEFT JOIN totals USING (prev)
       WHERE split = 'validation' GROUP BY batch_id),
sizes AS (SELECT batch_id, count(*) AS n FROM ev GROUP BY batch_id)"""
)


def _eval_losses(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    blocks = packed_blocks(docs, vocabulary(spark, sf), 128, ["doc_id"])
    return batch_losses(blocks, 8, K, vocabulary(spark, sf).count())


@query(
    "eval_batch_losses",
    f"WITH {EVAL_FLOW} SELECT batch_id, n, round(loss, 6) AS loss FROM losses JOIN sizes USING (batch_id)",
)
def eval_batch_losses(spark, sf):
    return _eval_losses(spark, sf).withColumn("loss", F.round("loss", 6))


@query(
    "evaluation_report",
    f"""WITH {EVAL_FLOW} SELECT round(avg(loss), 6) AS mean_loss, count(*) AS n_batches,
        round(exp(avg(loss)), 4) AS perplexity FROM losses""",
)
def evaluation_report(spark, sf):
    out = evaluate(_eval_losses(spark, sf))
    return out.select(
        F.round("mean_loss", 6).alias("mean_loss"), "n_batches", F.round("perplexity", 4).alias("perplexity")
    )
