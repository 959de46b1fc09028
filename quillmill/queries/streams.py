"""Streaming jobs run to the end of the given tables, and their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.queries.base import BLOCK, TOKENS, chunks_sql, joined, query, table, vocabulary
from quillmill.operators.tokenization import tokenize
from quillmill.session import scratch_path
from quillmill.sources.datasets import stream_documents
from quillmill.streaming import jobs


def _stream(spark, sf, name):
    """A table as a stream, be it a file or a folder of files."""
    schema = table(spark, sf, name).schema
    # as a pattern, since a stream takes a plain path for a folder
    return stream_documents(spark, f"{sf.rstrip('/')}/{name}.parque[t]", schema)


@query(
    "stream_chunks",
    f"""WITH {chunks_sql()} SELECT doc_id, chunk_idx, num_chunks,
        array_to_string(list_resize(part, real + missing, 0), ' ') AS input_ids FROM chunks""",
)
def stream_chunks(spark, sf):
    sink, state = scratch_path(spark, "chunks"), scratch_path(spark, "state")
    docs = _stream(spark, sf, "documents").select("doc_id", "text")
    jobs.stream_chunks(docs, vocabulary(spark, sf), BLOCK, sink, state).awaitTermination()
    out = spark.read.parquet(sink)
    return out.select("doc_id", "chunk_idx", "num_chunks", joined("input_ids").alias("input_ids"))


@query(
    "stream_pack",
    f"""WITH {TOKENS}, r AS (SELECT len(tok) AS n, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS group_id FROM toks)
        SELECT group_id, (sum(n) // {BLOCK})::BIGINT AS n_blocks FROM r GROUP BY group_id HAVING sum(n) >= {BLOCK}""",
)
def stream_pack(spark, sf):
    """The table arrives in parts, each met by a restarted stream; groups reach over them."""
    source, sink, state = (scratch_path(spark, name) for name in ("arriving", "packed", "state"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    schema = tokenize(docs, vocabulary(spark, sf)).schema
    for part in _parts(docs, "doc_id", 3):
        part.write.mode("append").parquet(source)
        ids = tokenize(stream_documents(spark, source, docs.schema), vocabulary(spark, sf))
        jobs.stream_pack(ids, BLOCK, ["doc_id"], sink, state, group_size=100).awaitTermination()
    blocks = jobs.packed_blocks(spark, sink, state, schema, BLOCK, ["doc_id"], 100)
    return blocks.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_blocks"))


def _parts(df, key, n):
    """``df`` in ``n`` ascending ranges of ``key``."""
    least, most = df.agg(F.min(F.col(key).cast("double")), F.max(F.col(key).cast("double"))).first()
    if least is None:
        return [df]
    place = F.floor((F.col(key).cast("double") - least) / max(most - least, 1e-9) * n)
    return [df.where(F.least(place, F.lit(n - 1)) == i) for i in range(n)]


WINDOWS = """SELECT epoch(time_bucket(INTERVAL 1 DAY, ts))::BIGINT AS window_start, user_id AS run_id,
       count(*) AS n_steps, round(sum(value), 4) AS loss_sum, min(value) AS min_loss, max(value) AS max_loss
       FROM events GROUP BY 1, 2"""


def _log(events):
    # event time needs a timestamp with time zone; sessions run in UTC
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("run_id"), F.col("value").alias("loss")
    )


def _flat(df):
    return df.select(
        F.unix_timestamp("window_start").alias("window_start"),
        "run_id",
        "n_steps",
        F.round("loss_sum", 4).alias("loss_sum"),
        "min_loss",
        "max_loss",
    )


@query("windowed_loss", WINDOWS)
def windowed_loss(spark, sf):
    out = jobs.windowed_loss(_log(table(spark, sf, "events")), "1 day")
    return _flat(out.withColumn("window_start", F.col("w.start")))


@query("stream_log_metrics", WINDOWS)
def stream_log_metrics(spark, sf):
    sink, state = scratch_path(spark, "windows"), scratch_path(spark, "state")
    log = _log(_stream(spark, sf, "events"))
    jobs.stream_log_metrics(log, "1 day", "1 hour", sink, state, complete=True).awaitTermination()
    return _flat(spark.read.parquet(sink))


@query(
    "stream_closed_windows",
    f"""SELECT * FROM ({WINDOWS}) WHERE window_start + 86400 <= (SELECT epoch(max(ts) - INTERVAL 1 HOUR) FROM events)""",
)
def stream_closed_windows(spark, sf):
    """Events arrive in three parts by time, and the first part's again with the last: too late to count.

    The watermark, an hour behind, closes windows from one trigger to the next and drops their state.
    """
    source, sink, state = (scratch_path(spark, name) for name in ("arriving", "windows", "state"))
    log = _log(table(spark, sf, "events"))
    parts = _parts(log, "ts", 3)
    for part in [*parts[:-1], parts[-1].unionByName(parts[0])]:
        part.write.mode("append").parquet(source)
        jobs.stream_log_metrics(stream_documents(spark, source, log.schema), "1 day", "1 hour", sink, state).awaitTermination()
    return _flat(spark.read.parquet(sink))
