"""Losses of rows against the formula, with all, some and none of the loss terms sent to the rows."""

import math
import random
from collections import Counter, defaultdict

import pytest

from quillmill.operators import bigram


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [(f"r{i % 90}", i, [min(int(rng.expovariate(0.2)), 50) for _ in range(rng.choice([0, 1, 2, 30, 200]))]) for i in range(200)]
    made += [(None, 7, [0, 0, 0, 1]), ("null", 8, None), ("unseen", 9, [900, 901, 900]), ("repeated", 10, [3, 4] * 500)]
    return made + [("hot", i, [70, 71, 0]) for i in range(3000)]  # a pair that the model hasn't, in most rows


@pytest.mark.parametrize("shipped", [1_000_000, 60, 1])
@pytest.mark.parametrize("ignore", [None, 3])
def test_row_losses(spark, rows, monkeypatch, shipped, ignore):
    monkeypatch.setattr(bigram, "HEAVY", 20)
    monkeypatch.setattr(bigram, "SALTS", 3)
    df = spark.createDataFrame(rows, "name string, part int, input_ids array<int>").repartition(6)
    train = [(r[2],) for r in rows[:150]] + [([70, 5],)]
    model = bigram.fit_bigram(spark.createDataFrame(train, "input_ids array<int>"), ignore=ignore).cache()
    k, size = 0.5, 1000

    def pairs(ids):
        return [p for p in zip(ids or [], (ids or [])[1:]) if ignore not in p]

    seen = Counter(p for (ids,) in train for p in pairs(ids))
    totals = Counter()
    for (first, _), c in seen.items():
        totals[first] += c
    losses = defaultdict(list)
    for name, _, ids in rows:
        losses[name] += [-math.log((seen[p] + k) / (totals[p[0]] + k * size)) for p in pairs(ids)]
    expected = {name: (len(v), sum(v) / len(v)) for name, v in losses.items() if v}
    got = {r["name"]: (r.n_pairs, r.loss) for r in bigram.score_rows(df, model, k, size, ["name"], ignore=ignore, max_shipped=shipped).collect()}
    assert got.keys() == expected.keys()
    for name, (n, loss) in expected.items():
        assert got[name][0] == n and got[name][1] == pytest.approx(loss, abs=1e-9)


def test_losses_of_rows_beyond_a_piece(spark):
    rows = [("a", [1, 2] * bigram.PIECE_ITEMS), ("b", [1, 2]), ("c", [1]), ("d", [2, 1] * 3)]
    df = spark.createDataFrame(rows, "name string, input_ids array<int>").coalesce(1)
    model = spark.createDataFrame([(1, 2, 3), (2, 1, 1)], "prev int, next int, c long")
    got = {r["name"]: r.n_pairs for r in bigram.score_rows(df, model, 0.5, 10, ["name"]).collect()}
    assert got == {"a": 2 * bigram.PIECE_ITEMS - 1, "b": 1, "d": 5}
