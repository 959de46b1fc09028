"""Streams give what the batch operators give, once."""

from pyspark.sql import functions as F

from quillmill.operators.packing import chunk_documents, pack_batches
from quillmill.operators.tokenization import tokenize
from quillmill.operators.vocab import build_vocab, with_reserved_specials
from quillmill.sources.datasets import stream_documents
from quillmill.streaming import jobs


def folder(spark, tmp_path, parts=3):
    path = str(tmp_path / "in")
    rows = [(i, "a b c d e f g"[: 1 + 2 * (i % 7)]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part in range(parts):
        df.where(F.col("doc_id") % parts == part).coalesce(1).write.mode("append").parquet(path)
    return df, path


def test_chunks_and_restart(spark, tmp_path):
    docs, path = folder(spark, tmp_path)
    vocab = with_reserved_specials(build_vocab(docs))
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = stream_documents(spark, path, docs.schema)
        jobs.stream_chunks(stream, vocab, 4, sink, state).awaitTermination()
        return sorted((r.doc_id, r.chunk_idx, r.input_ids) for r in spark.read.parquet(sink).collect())

    batch = chunk_documents(tokenize(docs, vocab), 4).collect()
    expected = sorted((r.doc_id, r.chunk_idx, r.input_ids) for r in batch)
    assert run() == expected
    assert run() == expected  # nothing new, nothing twice
    docs.where("doc_id = 3").withColumn("doc_id", F.lit(99).cast("long")).write.mode("append").parquet(path)
    extra = [r for r in run() if r[0] == 99]
    assert [r[2] for r in extra] == [r[2] for r in expected if r[0] == 3]


def test_pack_across_triggers_and_restarts(spark, tmp_path):
    """The same blocks for 1, 3 and 20 files per trigger, after a restart, and for the table at once."""
    source = str(tmp_path / "in")
    rows = [(i, [100 * i + t for t in range(i * 7 % 13)]) for i in range(18)]
    schema = "doc_id long, input_ids array<int>"
    df = spark.createDataFrame(rows, schema)

    def arrive(first, last):
        for i in range(first, last, 3):
            df.where(F.col("doc_id").between(i, i + 2)).coalesce(1).write.mode("append").parquet(source)

    def run(files, name):
        sink, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        stream = stream_documents(spark, source, schema, max_files=files)
        jobs.stream_pack(stream, 4, ["doc_id"], sink, state, group_size=7, columns=["input_ids"]).awaitTermination()
        out = jobs.packed_blocks(spark, sink, state, df.schema, 4, ["doc_id"], 7, columns=["input_ids"])
        return sorted((r.group_id, r.block_id, r.input_ids) for r in out.collect())

    def expected(n):
        packed = pack_batches(df.where(F.col("doc_id") < n), 4, ["doc_id"], 7, columns=["input_ids"])
        return sorted((r.group_id, r.block_id, r.input_ids) for r in packed.collect())

    arrive(0, 9)
    assert run(3, "restarted") == expected(9)
    arrive(9, 18)
    for files, name in ((3, "restarted"), (1, "one"), (20, "all")):
        assert run(files, name) == expected(18)
    assert run(1, "one") == expected(18)  # nothing new, nothing twice


def test_pack_replays_a_micro_batch(spark, tmp_path):
    """A micro-batch whose commit got lost is done again, with the same blocks."""
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = spark.createDataFrame([(i, [i] * 5) for i in range(25)], "doc_id long, input_ids array<int>")
    for part in range(2):
        df.where(F.floor(F.col("doc_id") / 13) == part).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = stream_documents(spark, source, df.schema, max_files=1)
        jobs.stream_pack(stream, 4, ["doc_id"], sink, state, group_size=10, columns=["input_ids"]).awaitTermination()
        out = jobs.packed_blocks(spark, sink, state, df.schema, 4, ["doc_id"], 10, columns=["input_ids"])
        return sorted((r.group_id, r.block_id, r.input_ids) for r in out.collect())

    first = run()
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    assert run() == first


def test_text_stream(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("x\ny\n")
    stream = stream_documents(spark, str(tmp_path / "t"), "value string", kind="text")
    query = stream.writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.text for r in spark.table("lines").collect()) == ["x", "y"]


def test_log_metrics(spark, tmp_path):
    rows = [(f"2024-01-01 00:{m:02d}:00", m % 2, float(m)) for m in range(50)]
    log = spark.createDataFrame(rows, "ts string, run_id int, loss double").withColumn("ts", F.to_timestamp("ts"))
    path = str(tmp_path / "in")
    log.write.parquet(path)
    batch = jobs.windowed_loss(log, "10 minutes").select("w.start", "run_id", "n_steps", "loss_sum")
    expected = {tuple(r) for r in batch.collect()}

    def run(name, complete):
        stream = stream_documents(spark, path, log.schema)
        sink = str(tmp_path / name)
        jobs.stream_log_metrics(
            stream, "10 minutes", "5 minutes", sink, sink + "-state", complete=complete
        ).awaitTermination()
        out = spark.read.parquet(sink).select("window_start", "run_id", "n_steps", "loss_sum")
        return [tuple(r) for r in out.collect()]

    assert sorted(run("all", True)) == sorted(expected)
    closed = run("closed", False)
    # windows still open at the watermark are not written yet
    assert len(closed) == len(set(closed)) and set(closed) < expected and len(closed) == 8


def test_late_rows_are_left_out(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "ts timestamp, run_id int, loss double"

    def arrive(*minutes):
        rows = [(f"2024-01-01 00:{m:02d}:00", 1, float(m)) for m in minutes]
        df = spark.createDataFrame(rows, "ts string, run_id int, loss double").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(source)
        jobs.stream_log_metrics(stream_documents(spark, source, schema), "10 minutes", "5 minutes", sink, state).awaitTermination()
        return sorted((r.window_start.minute, r.n_steps) for r in spark.read.parquet(sink).collect())

    assert arrive(1, 2, 12) == []
    assert arrive(13, 3, 27) == [(0, 3), (10, 2)]  # 3 is late but its window was open until this trigger
    assert arrive(4, 14, 28, 59) == [(0, 3), (10, 2), (20, 2)]  # 4 and 14 come after their windows


def test_queries_stream_tables_that_are_folders(spark, tmp_path):
    from quillmill.queries import QUERIES

    rows = [(i, " ".join(["a", "b", "c"] * (20 * i))) for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    chunks = QUERIES["stream_chunks"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.chunk_idx) for r in chunks) == [(i, j) for i in range(6) for j in range(-(-60 * i // 128))]
    assert {r.doc_id: r.num_chunks for r in chunks if r.chunk_idx == 0} == {i: 60 * i // 128 + (60 * i % 128 >= 64) for i in range(1, 6)}
    events = "SELECT id AS event_id, id % 2 AS user_id, timestamp_ntz'2024-01-01 00:00:00' AS ts, 1.0D AS value FROM range(6)"
    spark.sql(events).repartition(2).write.parquet(f"{tmp_path}/events.parquet")
    assert sorted((r.run_id, r.n_steps) for r in QUERIES["stream_log_metrics"](spark, str(tmp_path)).collect()) == [(0, 3), (1, 3)]
