"""The batch operators on streams. Every job needs its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from quillmill.operators.ordering import before_cut, with_cuts
from quillmill.operators.packing import TOKEN_COLUMNS, chunk_documents, pack_batches
from quillmill.operators.tokenization import tokenize


def _start(writer, once: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_chunks(
    stream: DataFrame,
    vocab: DataFrame,
    block: int,
    sink: str,
    checkpoint: str,
    tail: str = "keep",
    once: bool = True,
) -> StreamingQuery:
    """Tokenize and cut documents as they arrive: stateless, written exactly once."""
    blocks = chunk_documents(tokenize(stream, vocab), block, tail)
    writer = blocks.writeStream.format("parquet").outputMode("append")
    return _start(writer.option("path", sink).option("checkpointLocation", checkpoint), once)


def stream_pack(
    stream: DataFrame,
    block: int,
    order: Sequence[str],
    sink: str,
    checkpoint: str,
    group_size: int = 1000,
    once: bool = True,
    columns: Sequence[str] = TOKEN_COLUMNS,
) -> StreamingQuery:
    """Pack tokenized rows in groups of exactly ``group_size``, whatever the triggers' size.

    Rows follow one another by micro-batch, then by ``order``. Fewer than ``group_size`` rows wait for
    the next micro-batch, in a table of the checkpoint folder that belongs to the micro-batch it was
    written by. A micro-batch overwrites that table and the folder of blocks named after it, so a
    replay gives the same blocks once. :func:`packed_blocks` reads them, the open group included.
    """
    along = ["__batch", *order]

    def pack(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows = rows.withColumn("__batch", F.lit(batch).cast("bigint"))
        groups = 0
        if batch:
            rows = _waiting(spark, checkpoint, batch - 1, rows.schema).unionByName(rows)
            groups = spark.read.parquet(_open(checkpoint, batch - 1, "groups")).first()[0]
        rows.persist()  # packing reads its rows several times
        try:
            n = rows.count()
            cut = with_cuts(rows, along, {"__cut": lambda n: n - n % group_size})
            whole = before_cut(along, "__cut")
            blocks = pack_batches(cut.where(whole), block, along, group_size, columns=columns)
            blocks.withColumn("group_id", F.col("group_id") + groups).write.mode("overwrite").parquet(f"{sink}/micro_batch={batch}")
            cut.where(~whole).drop("__cut").write.mode("overwrite").parquet(_open(checkpoint, batch, "rows"))
            done = spark.range(1).select(F.lit(groups + n // group_size).cast("bigint").alias("groups"), F.lit(batch).alias("batch"))
            done.write.mode("overwrite").parquet(_open(checkpoint, batch, "groups"))
        finally:
            rows.unpersist()

    return _start(stream.writeStream.foreachBatch(pack).option("checkpointLocation", checkpoint), once)


def _open(checkpoint: str, batch: int | str, part: str) -> str:
    return f"{checkpoint.rstrip('/')}/open-group/{batch}/{part}"


def _waiting(spark: SparkSession, checkpoint: str, batch: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(_open(checkpoint, batch, "rows"))


def packed_blocks(
    spark: SparkSession,
    sink: str,
    checkpoint: str,
    schema: StructType,
    block: int,
    order: Sequence[str],
    group_size: int = 1000,
    columns: Sequence[str] = TOKEN_COLUMNS,
) -> DataFrame:
    """What :func:`stream_pack` has written for rows of ``schema``, and the blocks of the group that is still open.

    As the end of a table ends a group, this is what packing all rows seen so far at once would give.
    """
    done = spark.read.parquet(_open(checkpoint, "*", "groups")).agg(F.max(F.struct("batch", "groups")).alias("last")).first()[0]
    rows = _waiting(spark, checkpoint, done.batch, StructType([*schema.fields, StructField("__batch", LongType())]))
    rest = pack_batches(rows, block, ["__batch", *order], group_size, columns=columns).withColumn("group_id", F.col("group_id") + done.groups)
    return spark.read.parquet(sink).drop("micro_batch").unionByName(rest)


def windowed_loss(log: DataFrame, width: str, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Steps and loss of every run in every time window; the same on tables and streams."""
    return log.groupBy(F.window("ts", width).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.sum("loss").alias("loss_sum"),
        F.min("loss").alias("min_loss"),
        F.max("loss").alias("max_loss"),
    )


def stream_log_metrics(
    stream: DataFrame,
    width: str,
    delay: str,
    sink: str,
    checkpoint: str,
    by: Sequence[str] = ("run_id",),
    complete: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Windowed metrics of a log with event time ``ts`` (a timestamp with time zone).

    A window is written once the watermark passes its end, and its state is then
    dropped. With ``complete`` every trigger rewrites the table of all windows.
    """
    metrics = windowed_loss(stream.withWatermark("ts", delay), width, by)
    flat = metrics.select(F.col("w.start").alias("window_start"), *by, "n_steps", "loss_sum", "min_loss", "max_loss")
    if complete:

        def rewrite(table: DataFrame, _: int) -> None:
            table.write.mode("overwrite").parquet(sink)

        writer = flat.writeStream.outputMode("complete").foreachBatch(rewrite)
    else:
        writer = flat.writeStream.outputMode("append").format("parquet").option("path", sink)
    return _start(writer.option("checkpointLocation", checkpoint), once)
