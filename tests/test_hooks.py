"""Mergeable metrics against one call over the whole group."""

import math
import random

import pytest

from quillmill.operators import hooks


def moments():
    """Mean and variance by merging (n, mean, squares), which one pass over sums would round worse."""

    def merge(a, b):
        n = a[0] + b[0]
        if not n:
            return a
        delta = b[1] - a[1]
        return n, a[1] + delta * b[0] / n, a[2] + b[2] + delta * delta * a[0] * b[0] / n

    def update(state, preds, labels):
        for p, l in zip(preds, labels):
            state = merge(state, (1, float(p - l), 0.0))
        return state

    def finish(state):
        return {"n": state[0], "mean": state[1], "var": state[2] / state[0] if state[0] else math.nan}

    return hooks.MergeableMetric(lambda: (0, 0.0, 0.0), update, merge, finish)


@pytest.mark.parametrize("fan_in,most", [(64, 10_000), (2, 1)])
def test_merged_states_equal_one_call(spark, monkeypatch, fan_in, most):
    monkeypatch.setattr(hooks, "FAN_IN", fan_in)
    monkeypatch.setattr(hooks, "MAX_STATES", most)
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), rng.random(), rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "part string, preds double, labels double").repartition(9)

    def plain(values):
        mean = sum(values) / len(values)
        return len(values), mean, sum((v - mean) ** 2 for v in values) / len(values)

    got = {r.part: (r.n, r.mean, r["var"]) for r in hooks.apply_mergeable_metric(df, moments(), ["n", "mean", "var"], ["part"]).collect()}
    assert got.keys() == {r[0] for r in rows}
    for part, values in got.items():
        assert values == pytest.approx(plain([p - l for q, p, l in rows if q == part]))
    whole = hooks.apply_mergeable_metric(df, moments(), ["n", "mean", "var"]).collect()
    assert len(whole) == 1 and tuple(whole[0]) == pytest.approx(plain([p - l for _, p, l in rows]))


def test_metric_of_no_rows(spark):
    empty = spark.createDataFrame([], "part string, preds double, labels double")
    assert hooks.apply_mergeable_metric(empty, moments(), ["n"], ["part"]).collect() == []
    assert [r.n for r in hooks.apply_mergeable_metric(empty, moments(), ["n"]).collect()] == [0]


def test_no_group_meets_in_a_task(spark):
    """Rows are not exchanged, only states are."""
    df = spark.range(100).selectExpr("'x' as part", "1.0d as preds", "id * 1.0d as labels")
    text = hooks.apply_mergeable_metric(df, moments(), ["n"], ["part"])._jdf.queryExecution().executedPlan().toString()
    assert text.index("FlatMapGroupsInPandas") < text.index("Exchange") < text.index("MapInPandas")
    assert "labels" not in text[text.index("Exchange") : text.index("MapInPandas")]
