"""Run-log analytics against plain loops, and hot keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quillmill.functions.columns import round_binary
from quillmill.operators import bigram, checkpoints, hooks, metrics, runlog, splits
from quillmill.operators.lookup import lookup_join

NAN, INF = float("nan"), float("inf")


def random_log(rng, runs=30):
    rows = []
    for run in range(runs):
        for step in range(1, rng.randrange(2, 40)):
            loss = rng.choice([NAN, INF, -INF]) if rng.random() < 0.15 else round(rng.uniform(0, 9), 3)
            rows.append((f"r{run}", step, loss))
    return rows


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, abs=1e-9)


def test_nan_filter_recurrence(spark):
    rows = random_log(random.Random(1))
    log = spark.createDataFrame(rows, "run_id string, step long, loss double")
    got = {(r.run_id, r.interval_id): r.loss_sum for r in runlog.interval_sums(log, 5, nan_filter=True).collect()}
    expected, total, logged = {}, {}, {}
    for run, step, loss in rows:
        tr, since = total.get(run, 0.0), logged.get(run, 0)
        done = step - 1
        tr += tr / (1 + done - since) if math.isnan(loss) or math.isinf(loss) else loss
        expected[(run, -(-step // 5))] = tr
        total[run] = 0.0 if step % 5 == 0 else tr
        logged[run] = step if step % 5 == 0 else since
    assert got.keys() == expected.keys()
    assert all(same(got[k], expected[k]) for k in got)


@pytest.mark.parametrize("greater", [False, True])
def test_best_and_running_best(spark, small_buckets, greater):
    rng = random.Random(2)
    rows = []
    for run in range(40):
        for step in range(1, rng.randrange(2, 30)):
            rows.append((f"r{run}", step, NAN if rng.random() < 0.2 else float(rng.randrange(6))))
    log = spark.createDataFrame(rows, "run_id string, step long, metric double")
    best, seen = {}, {}
    for run, step, m in rows:
        if run not in best or (m > best[run][1] if greater else m < best[run][1]):
            best[run] = (step, m)
        seen[(run, step)] = best[run][1]
    got = {r.run_id: (r.best_step, r.best_metric) for r in runlog.best_checkpoint(log, greater=greater).collect()}
    assert got.keys() == best.keys()
    assert all(got[k][0] == best[k][0] and same(got[k][1], best[k][1]) for k in got)
    running = {(r.run_id, r.step): r.running_best for r in runlog.running_best(log, greater=greater).collect()}
    assert all(same(running[k], seen[k]) for k in seen)


@pytest.mark.parametrize("limit", [1, 2, 3, 5])
def test_retention(spark, limit):
    rng = random.Random(3)
    rows, best, expected = [], [], set()
    for run in range(100):
        steps = sorted(rng.sample(range(1, 100), rng.randrange(1, 9)))
        top = rng.choice(steps + [None])
        rows += [(run, s) for s in steps]
        kept = list(steps)
        if top is not None:
            best.append((run, top))
            i = kept.index(top)
            if i < len(kept) - 2:
                kept = kept[:i] + kept[i + 1 : -1] + [top, kept[-1]]
        allowed = 2 if limit == 1 and top is not None and kept[-1] != top else limit
        expected |= {(run, s) for s in kept[-allowed:]}
    ckpts = spark.createDataFrame(rows, "run_id long, step long")
    known = spark.createDataFrame(best, "run_id long, best_step long")
    got = {(r.run_id, r.step) for r in checkpoints.retained_checkpoints(ckpts, known, limit).collect()}
    assert got == expected


def test_rounding_is_that_of_python(spark):
    rng = random.Random(9)
    values = [22.99825, 32.87875, 0.00005, -0.00015, 2.5, 1e9 + 0.00005, 0.0, 1.00005, NAN, INF, -INF]
    values += [rng.randrange(10**7) / 10**5 for _ in range(2000)] + [rng.uniform(-9, 9) for _ in range(500)]
    values += [rng.randrange(10**6) / 8 / 10**3 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", round_binary(F.col("v"), 4).alias("r")).collect():
        expected = round(r.v, 4) if math.isfinite(r.v) else r.v
        assert r.r == expected or (math.isnan(r.r) and math.isnan(expected)), r


def test_metric_names(spark):
    log = spark.createDataFrame(
        [("r", 1, {"eval_loss": 2.0}), ("r", 2, {"loss": 1.0})], "run_id string, step long, metrics map<string,double>"
    )
    assert [(r.step, r.metric) for r in runlog.with_metric(log, "loss").collect()] == [(1, 2.0)]
    assert runlog.metric_name("eval_x") == "eval_x"


def test_lookup_with_a_hot_key(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, -1).otherwise(F.col("id")).alias("k")
    )
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    out = {r.id: (r.k, r.v) for r in lookup_join(left, right, ["k"], hot_keys=2).collect()}
    assert len(out) == 3000
    assert all(v == (k * 10 if k >= 0 and k % 2 == 0 else None) for k, v in out.values())
    counted = left.groupBy("k").count().join(right, "k", "left")
    same_rows = {r.id: (r.k, r.v) for r in lookup_join(left, counted, ["k"], 2, frequency="count").collect()}
    assert same_rows == out


def test_scores_agree(spark):
    rng = random.Random(4)
    docs = [(i, [rng.randrange(6) for _ in range(rng.randrange(0, 30))]) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, input_ids array<int>")
    train, held = df.where("doc_id < 40"), df.where("doc_id >= 40")
    counts, totals = {}, {}
    for i, ids in docs:
        for p, n in zip(ids, ids[1:]):
            if i < 40:
                counts[p, n] = counts.get((p, n), 0) + 1
                totals[p] = totals.get(p, 0) + 1
    k, size = 0.5, 7
    loss = lambda p, n: -math.log((counts.get((p, n), 0) + k) / (totals.get(p, 0) + k * size))
    model = bigram.fit_bigram(train)
    got = {r.doc_id: (r.n_pairs, r.loss) for r in bigram.score_rows(held, model, k, size, ["doc_id"]).collect()}
    expected = {}
    for i, ids in docs:
        losses = [loss(p, n) for p, n in zip(ids, ids[1:])]
        if i >= 40 and losses:
            expected[i] = (len(losses), sum(losses) / len(losses))
    assert got.keys() == expected.keys()
    assert all(got[i][0] == expected[i][0] and same(got[i][1], expected[i][1]) for i in got)
    overall = bigram.score_shards(bigram.count_pairs(held), model, k, size).first()
    n = sum(c for c, _ in expected.values())
    assert overall.n_pairs == n and same(overall.mean_loss, sum(c * m for c, m in expected.values()) / n)


def test_curriculum_matches_shard_by_shard(spark):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        split = rng.choice(["train", "train", "val", "test"])
        rows.append((i, split, rng.randrange(2), rng.randrange(1, 4), [rng.randrange(5) for _ in range(12)]))
    df = spark.createDataFrame(rows, "doc_id long, split string, year int, month int, input_ids array<int>")
    got = {(r.year, r.month): r.mean_loss for r in bigram.curriculum(df, 0.1, 9).collect()}
    for (year, month), value in got.items():
        until = F.col("year") * 100 + F.col("month") <= year * 100 + month
        model = bigram.fit_bigram(df.where((F.col("split") == "train") & until))
        held = df.where((F.col("split") == "val") & (F.col("year") == year) & (F.col("month") == month))
        assert same(bigram.score_shards(bigram.count_pairs(held), model, 0.1, 9).first().mean_loss, value)
    assert len(got) == len({(y, m) for _, s, y, m, _ in rows if s == "val"})


def test_curriculum_tasks_grow_with_the_tokens(spark, monkeypatch):
    """However large the table, a task has a bounded share of the pairs."""
    rng = random.Random(9)
    kinds = ["train", "train", "val", "test"]
    rows = [(i, rng.choice(kinds), rng.randrange(2), 1 + i % 3, [rng.randrange(40) for _ in range(50)]) for i in range(200)]
    rows += [(-1, "val", 0, 1, None), (-2, "train", 0, 1, []), (-3, "val", 1, 2, [7])]
    df = spark.createDataFrame(rows, "doc_id long, split string, year int, month int, input_ids array<int>")
    expected = ordered_losses(bigram.curriculum(df, 0.1, 41))
    tasks, written = [], bigram.materialize

    def counted(table, name):
        held = table.groupBy(F.spark_partition_id()).count().collect()
        tasks.append((len(held), max(r["count"] for r in held)))
        return written(table, name)

    monkeypatch.setattr(bigram, "materialize", counted)
    monkeypatch.setattr(bigram, "TASK_TOKENS", 200)
    got = ordered_losses(bigram.curriculum(df, 0.1, 41))
    assert [g[:3] for g in got] == [e[:3] for e in expected] and all(same(g[3], e[3]) for g, e in zip(got, expected))
    assert tasks[0][0] > 30 and tasks[0][1] < 600


def ordered_losses(found):
    return sorted((r.year, r.month, r.n_pairs, r.mean_loss) for r in found.collect())


def test_map_batches_regroups(spark):
    sizes = lambda batch: {"n": [len(batch["id"])]}
    out = hooks.map_batches(spark.range(0, 25, 1, 1), sizes, "n long", 10, ["id"])
    assert sorted(r.n for r in out.collect()) == [5, 10, 10]
    same_rows = hooks.map_batches(spark.range(5), lambda b: {"twice": [2 * i for i in b["id"]]}, "id long, twice long")
    assert all(r.twice == 2 * r.id for r in same_rows.collect())


def test_hooks(spark):
    df = spark.createDataFrame([(0, [0.1, 0.9], 1), (0, [0.8, 0.2], 1)], "batch_id long, logits array<double>, label int")
    from quillmill.functions.columns import argmax_token

    reduced = hooks.apply_logits_hook(df, argmax_token)
    assert reduced.columns == ["batch_id", "label", "preds"]
    rate = hooks.aggregate_metric(reduced, {"accuracy": F.avg((F.col("preds") == F.col("label")).cast("double"))})
    assert rate.first().accuracy == 0.5


def test_padded_predictions(spark):
    df = spark.createDataFrame([([1],), ([1, 2, 3],), ([],)], "preds array<int>")
    assert sorted(r.preds for r in metrics.pad_predictions(df).collect()) == [
        [-100, -100, -100], [1, -100, -100], [1, 2, 3],
    ]


def test_gathered_loss_weights(spark):
    df = spark.createDataFrame([(1.0, 8), (3.0, 2)], "loss double, n long")
    means = {w: metrics.mean_loss(df, weighting=w, batch_size=8).first().mean_loss for w in ("batch", "sample", "gathered")}
    assert means == {"batch": 2.0, "sample": 1.4, "gathered": 1.4}


def test_records_without_a_metric_never_win(spark):
    nan = float("nan")
    log = spark.createDataFrame(
        [("a", 1, 3.0), ("a", 2, None), ("a", 3, 2.0), ("b", 1, None), ("c", 1, None), ("c", 2, nan), ("c", 3, 1.0)],
        "run_id string, step long, metric double",
    )
    best = {r.run_id: (r.best_step, r.best_metric) for r in runlog.best_checkpoint(log).collect()}
    assert best["a"] == (3, 2.0) and best["b"] == (None, None)
    assert best["c"][0] == 2 and best["c"][1] != best["c"][1]
    ends = spark.createDataFrame([("a", 1, 5.0), ("b", 1, nan), ("c", 1, None), ("d", 1, 7.0)], "run_id string, step long, metric double")
    assert [r.run_id for r in runlog.leaderboard(ends, 3, "maximize").collect()] == ["d", "a", "b"]
    assert [r.run_id for r in runlog.leaderboard(ends, 3, "minimize").collect()] == ["a", "d", "b"]


def test_predictions_padded_by_batch(spark):
    df = spark.createDataFrame([(0, [1]), (0, [1, 2, 3]), (1, [4]), (1, []), (2, None)], "batch_id int, preds array<int>")
    got = [(r.batch_id, r.preds) for r in metrics.pad_predictions(df, by=["batch_id"]).collect()]
    assert sorted(got, key=str) == [(0, [1, -100, -100]), (0, [1, 2, 3]), (1, [-100]), (1, [4]), (2, None)]


def test_many_first_rows(spark, monkeypatch):
    monkeypatch.setattr(splits, "HEAP_ROWS", 3)
    df = spark.range(50).repartition(4)
    for n in (3, 4, 49, 50, 51):
        assert sorted(r.id for r in splits.take_first(df, n, ["id"]).collect()) == list(range(min(n, 50)))
