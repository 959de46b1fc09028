"""Hand-checked cases."""

import pytest
from pyspark.sql import functions as F

from quillmill.functions import columns as c
from quillmill.functions.arguments import resolve_block_size, resolve_interval, sample_sizes
from quillmill.operators import batching as b
from quillmill.operators import checkpoints, combine, metrics, packing, splits, stats
from quillmill.operators import columns as cols
from quillmill.schemas import VOCAB, require

LENGTHS = [0, 1, 2, 3, 4, 5, 9, 10]


def id_docs(spark, lengths, start=1):
    rows, nxt = [], start
    for i, n in enumerate(lengths):
        rows.append((i, list(range(nxt, nxt + n)), [1] * n))
        nxt += n
    return spark.createDataFrame(rows, "doc_id long, input_ids array<int>, attention_mask array<int>")


def chunks(spark, **options):
    out = packing.chunk_documents(id_docs(spark, LENGTHS), 4, **options).orderBy("doc_id", "chunk_idx").collect()
    by_n = {n: [] for n in LENGTHS}
    for row in out:
        by_n[LENGTHS[row.doc_id]].append(row)
    return by_n


def test_chunk_lengths_keep(spark):
    got = {n: [len(r.input_ids) for r in rows] for n, rows in chunks(spark).items()}
    assert got == {0: [], 1: [1], 2: [4], 3: [4], 4: [4], 5: [4, 1], 9: [4, 4, 1], 10: [4, 4, 4]}


def test_chunk_lengths_drop(spark):
    by_n = chunks(spark, tail="drop")
    assert {n: [len(r.input_ids) for r in rows] for n, rows in by_n.items()} == {
        0: [], 1: [], 2: [4], 3: [4], 4: [4], 5: [4], 9: [4, 4], 10: [4, 4, 4],
    }
    assert all(rows[0].num_chunks == len(rows) for rows in by_n.values() if rows)


def test_chunk_counts_and_pads(spark):
    by_n = chunks(spark)
    assert {n: rows[0].num_chunks for n, rows in by_n.items() if rows} == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1, 9: 2, 10: 3}
    assert all(r.num_chunks == -1 for rows in by_n.values() for r in rows[1:])
    assert {n: sum(len(r.input_ids) - sum(r.attention_mask) for r in rows) for n, rows in by_n.items()} == {
        0: 0, 1: 0, 2: 2, 3: 1, 4: 0, 5: 0, 9: 0, 10: 2,
    }


def test_pad_id_in_every_column(spark):
    row = chunks(spark, pad_id=9, mask_pad=9)[3][0]
    assert row.input_ids[-1] == 9 and row.attention_mask == [1, 1, 1, 9]


def test_unknown_tail(spark):
    with pytest.raises(ValueError):
        packing.chunk_documents(id_docs(spark, [1]), 4, tail="trim")


def test_packing_one_batch(spark):
    out = packing.pack_batches(id_docs(spark, [3, 9, 1]), 4, ["doc_id"]).orderBy("block_id").collect()
    assert [r.input_ids for r in out] == [[1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 12]]
    assert [r.labels for r in out] == [r.input_ids for r in out]


def test_labels(spark):
    df = spark.createDataFrame([([5, 0, 6, 0],)], "input_ids array<int>")
    assert packing.with_labels(df, pad_id=0).first().labels == [5, -100, 6, -100]
    assert packing.with_labels(df).first().labels == [5, 0, 6, 0]


def test_shard_keys(spark):
    df = spark.createDataFrame([(0, 1), (12, 11)], "year int, month int")
    y, m = F.col("year"), F.col("month")
    got = df.select(c.shard_key(y, m), c.shard_label(y, m)).collect()
    assert [tuple(r) for r in got] == [(1, "0001"), (1211, "1211")]


@pytest.mark.parametrize(
    "n, fractions, expected",
    [
        (7, {"val": 0.5, "test": 0.5}, {"val": 3, "test": 3, None: 1}),
        (100, {"train": 0.29}, {"train": 28, None: 72}),
        (5, {"val": 0.0, "test": 1.0}, {"test": 5}),
    ],
)
def test_head_fractions(spark, small_buckets, n, fractions, expected):
    df = spark.range(n).select(F.lit(0).alias("year"), F.lit(1).alias("month"), "id")
    kept = splits.head_fraction_split(df, fractions, ["id"])
    got = {r["split"]: r["count"] for r in kept.groupBy("split").count().collect()}
    assert got == {k: v for k, v in expected.items() if k is not None}
    first = kept.groupBy("split").agg(F.min("id").alias("m")).collect()
    assert all(r.m == (3 if r.split == "test" and n == 7 else 0) for r in first)


def test_reroot(spark):
    df = spark.createDataFrame([("/a/b/c/d/e/f/g.tex",)], "p string")
    assert df.select(c.reroot_path(F.col("p"), "/root")).first()[0] == "/root/f/g.tex"


def test_accuracy(spark):
    df = spark.createDataFrame([([5, 6, 7], [1, 5, 6])], "preds array<int>, labels array<int>")
    assert tuple(metrics.token_accuracy(df).first()) == (2, 2, 1.0)
    masked = spark.createDataFrame([([5, 6, 7], [1, -100, 6])], "preds array<int>, labels array<int>")
    assert tuple(metrics.token_accuracy(masked, mask=True).first()) == (1, 1, 1.0)


def test_perplexity(spark):
    df = spark.createDataFrame([(0.0,), (1000.0,)], "mean_loss double")
    got = {r.mean_loss: r.perplexity for r in metrics.perplexity(df).collect()}
    assert got == {0.0: 1.0, 1000.0: float("inf")}


def test_retention(spark):
    ckpts = spark.createDataFrame([("a", s) for s in range(1, 6)], "run_id string, step long")
    best = spark.createDataFrame([("a", 1)], "run_id string, best_step long")

    def keep(limit, **kw):
        return sorted(r.step for r in checkpoints.retained_checkpoints(ckpts, best, limit, **kw).collect())

    assert keep(3) == [1, 4, 5]
    assert keep(1) == [1, 5]
    assert keep(1, at_end=True) == [1]
    assert keep(0) == [1, 2, 3, 4, 5]
    assert keep(9) == [1, 2, 3, 4, 5]


def test_retention_without_best(spark):
    ckpts = spark.createDataFrame([("a", s) for s in range(1, 6)], "run_id string, step long")
    none = spark.createDataFrame([], "run_id string, best_step long")
    assert [r.step for r in checkpoints.retained_checkpoints(ckpts, none, 1).collect()] == [5]


def test_step_plan(spark):
    rows = spark.range(40).select(F.lit(0).alias("year"), F.lit(1).alias("month"))
    floor = stats.step_plan(rows, 4, 4).first()
    ceil = stats.step_plan(rows, 4, 4, rounding="ceil").first()
    assert (floor.n_batches, floor.updates_per_epoch, ceil.updates_per_epoch) == (10, 2, 3)
    capped = stats.step_plan(rows, 4, 4, max_steps=5).first()
    assert (capped.total_steps, capped.n_epochs, capped.n_samples) == (5, 3, 80.0)


def test_resume():
    assert b.resume_point(7, 3, 4) == (2, 4)
    assert b.resume_point_by_batches(7, 13, 4) == (2, 2)
    assert b.resume_point_of("out/step_7", 13, 4) == (2, 2) and b.resume_point_of("epoch_3.pt/", 13, 4) == (4, 0)
    for bad in ("checkpoint-7", "step_", "epoch_x", "step_7/x"):
        with pytest.raises(ValueError):
            b.resume_point_of(bad, 13, 4)


def test_resume_reads_later_batches(spark, tmp_path):
    path = str(tmp_path / "b")
    b.write_batches(spark.range(100).withColumn("batch_id", F.floor(F.col("id") / 8)), path)
    rest = b.resume_batches(spark, path, "step_5", 2)
    assert sorted(r.id for r in rest.collect()) == list(range(80, 100)) and rest.first().epoch == 0
    text = rest._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(batch_id,10)" in text
    assert {r.epoch for r in b.resume_batches(spark, path, "epoch_0", 2).collect()} == {1}


def test_optimizer_steps_short_epoch(spark):
    # 3 batches per epoch, 4 per step: every epoch ends with a step, and so does every 4th batch
    rows = [(e, i) for e in range(3) for i in range(3)]
    df = spark.createDataFrame(rows, "epoch int, batch_id long")
    got = [(r.is_update, r.step) for r in b.assign_steps(df, 4).orderBy("epoch", "batch_id").collect()]
    expected, seen, step = [], 0, 1
    for _, i in rows:
        seen += 1
        update = seen % 4 == 0 or i == 2
        expected.append((update, step))
        step += update
    assert got == expected


def test_missing_shards(spark):
    grid = combine.shard_grid(spark, 1, 3)
    present = spark.createDataFrame(
        [("train", 0, 1), ("val", 0, 1), ("train", 0, 2)], "split string, year int, month int"
    )
    got = {(r.month, r.no_train, r.no_val) for r in combine.missing_shards(grid, present).collect()}
    assert got == {(2, False, True), (3, True, True)}
    with pytest.raises(FileNotFoundError):
        combine.missing_shards(grid, present, "stop")
    assert combine.shard_grid(spark).count() == 288


def test_signature(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    kept, ignored = cols.select_signature(df, ["c", "x", "a"])
    assert kept.columns == ["c", "a"] and ignored == ["b"]


def test_debug_mode_has_no_bibliography(spark):
    a, z = spark.range(2), spark.range(3)
    assert combine.union_sources(a, z, debug=True).count() == 2
    assert combine.union_sources(a, z).count() == 5


def test_arguments():
    assert resolve_block_size(None, 10**9) == 1024
    assert resolve_block_size(None, 512) == 512
    assert resolve_block_size(4096, 2048) == 2048
    assert resolve_block_size(None, 4096, 512) == 512
    assert sample_sizes(2, 10) == (40, 40)
    assert sample_sizes(2, 10, version=3) == (60, 10)
    assert resolve_interval(0.1, 95) == 10 and resolve_interval(5, 95) == 5


def test_schema_check(spark):
    good = spark.createDataFrame([("a", 1, 2)], "token string, id int, n int")
    assert require(good, VOCAB).columns == ["token", "id"]
    with pytest.raises(ValueError):
        require(spark.createDataFrame([("a",)], "token string"), VOCAB)
    with pytest.raises(ValueError):
        require(spark.createDataFrame([("a", "1")], "token string, id string"), VOCAB)
