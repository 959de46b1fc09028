"""User functions over batches, metrics, logits and collation."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States of a metric that meet in one merge, and groups whose states a task holds.
FAN_IN, MAX_STATES = 64, 10_000


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: str,
    batch_size: int = 1000,
    remove_columns: Sequence[str] = (),
) -> DataFrame:
    """Apply ``fn`` to dictionaries of columns, ``batch_size`` rows at a time.

    ``fn`` may return any number of rows. The columns it does not return are
    carried on when the number of rows is unchanged, unless removed. Batches do
    not cross partitions; use batch ids where their limits matter.
    """
    removed = set(remove_columns)
    names = [part.strip().split()[0].strip("`") for part in _fields(schema)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        held = 0
        for frame in frames:
            while len(frame):
                head = frame.iloc[: batch_size - held]
                frame = frame.iloc[len(head) :]
                waiting.append(head)
                held += len(head)
                if held == batch_size:
                    yield apply(pd.concat(waiting, ignore_index=True))
                    waiting, held = [], 0
        if held:
            yield apply(pd.concat(waiting, ignore_index=True))

    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        result = fn({c: frame[c].tolist() for c in frame.columns})
        carried = {c: frame[c] for c in frame.columns if c not in removed and c not in result}
        return pd.DataFrame({**carried, **result})[names]

    return df.mapInPandas(run, schema)


def _fields(schema: str) -> list[str]:
    """Top-level fields of a DDL schema."""
    fields, depth, current = [], 0, ""
    for ch in schema:
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            fields.append(current)
            current = ""
        else:
            current += ch
    return [*fields, current]


def apply_metric(
    df: DataFrame,
    fn: Callable[[list, list], dict[str, float]],
    names: Sequence[str],
    by: Sequence[str],
    preds: str = "preds",
    labels: str = "labels",
) -> DataFrame:
    """A user metric ``fn(predictions, labels) -> dict`` of every group.

    The whole group reaches one call, so group by batch (and average after), or
    use :func:`aggregate_metric` for metrics that are sums and
    :func:`apply_mergeable_metric` for others.
    """
    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in by] + [f"`{n}` double" for n in names])
    keys = list(by)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        values = fn(frame[preds].tolist(), frame[labels].tolist())
        head = {c: [frame[c].iloc[0]] for c in keys}
        return pd.DataFrame({**head, **{n: [float(values[n])] for n in names}})

    return df.select(*keys, preds, labels).groupBy(*keys).applyInPandas(run, schema)


class MergeableMetric:
    """A user metric in four parts, so that no group needs to be in one place.

    ``zero()`` gives an empty state, ``update(state, predictions, labels)`` takes in a batch of rows,
    ``merge(state, other)`` joins two states, both in any order; ``finish(state)`` gives the dict of
    values. States are pickled, so they should stay small.
    """

    def __init__(
        self,
        zero: Callable[[], Any],
        update: Callable[[Any, list, list], Any],
        merge: Callable[[Any, Any], Any],
        finish: Callable[[Any], dict[str, float]],
    ) -> None:
        self.zero, self.update, self.merge, self.finish = zero, update, merge, finish


def apply_mergeable_metric(
    df: DataFrame,
    metric: MergeableMetric,
    names: Sequence[str],
    by: Sequence[str] = (),
    preds: str = "preds",
    labels: str = "labels",
) -> DataFrame:
    """A user metric of every group, or of the whole table: one state per task and group, merged as a tree.

    A task keeps at most ``MAX_STATES`` states and passes them on when it has more groups. ``FAN_IN``
    states meet in one merge, so a group's last merge has few however many tasks there were. Null
    keys are a group. No rows give no groups, and without ``by`` the values of the empty state.
    """
    keys = list(by)
    types = dict(df.dtypes)
    key_schema = [f"`{c}` {types[c]}" for c in keys]
    zero, update, merge, finish = metric.zero, metric.update, metric.merge, metric.finish

    def flush(states: dict[tuple, tuple[tuple, Any]], task: int) -> pd.DataFrame:
        rows = [(*values, task, pickle.dumps(state)) for values, state in states.values()]
        states.clear()
        return pd.DataFrame(rows, columns=[*keys, "__lane", "__state"])

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, tuple[tuple, Any]] = {}
        task = TaskContext.get().partitionId()
        for frame in frames:
            groups = frame.groupby(keys, dropna=False, sort=False) if keys else [((), frame)]
            for found, rows in groups:
                found = found if isinstance(found, tuple) else (found,)
                mark = tuple("" if pd.isna(v) else v for v in found), tuple(bool(pd.isna(v)) for v in found)
                own = tuple(rows[c].iloc[0] for c in keys)
                at = states[mark][1] if mark in states else zero()
                states[mark] = own, update(at, rows[preds].tolist(), rows[labels].tolist())
            if len(states) > MAX_STATES:
                yield flush(states, task)
        if states:
            yield flush(states, task)

    def merged(frame: pd.DataFrame) -> Any:
        state = zero()
        for other in frame["__state"]:
            state = merge(state, pickle.loads(other))
        return state

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        head = frame.iloc[:1][keys].assign(__lane=int(frame["__lane"].iloc[0]) // FAN_IN)
        return head.assign(__state=[pickle.dumps(merged(frame))])[[*keys, "__lane", "__state"]]

    def last(frame: pd.DataFrame) -> pd.DataFrame:
        values = finish(merged(frame))
        return frame.iloc[:1][keys].assign(**{n: [float(values[n])] for n in names})[[*keys, *names]]

    rows = df.select(*keys, preds, labels)
    tasks = rows.rdd.getNumPartitions()
    state_schema = ", ".join([*key_schema, "__lane long", "__state binary"])
    states = rows.mapInPandas(partial, state_schema)
    while tasks > FAN_IN:
        lane = F.floor(F.col("__lane") / FAN_IN)
        states = states.groupBy(*keys, lane.alias("__lanes")).applyInPandas(join, state_schema)
        tasks = -(-tasks // FAN_IN)
    out_schema = ", ".join([*key_schema, *[f"`{n}` double" for n in names]])
    if not keys:
        empty = df.sparkSession.range(1).select(F.lit(0).cast("long").alias("__lane"), F.lit(pickle.dumps(zero())).alias("__state"))
        states = states.unionByName(empty)
    return states.groupBy(*keys).applyInPandas(last, out_schema)


def aggregate_metric(df: DataFrame, metric: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """The preferred form of a metric: aggregate expressions."""
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in metric.items()])


def apply_logits_hook(df: DataFrame, fn: Callable[[Column], Column], logits: str = "logits", out: str = "preds"):
    """Reduce logits before metrics see them, for example to their argmax."""
    return df.withColumn(out, fn(F.col(logits))).drop(*([logits] if out != logits else []))


def collate_with(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch_col: str = "batch_id"
) -> DataFrame:
    """A user collate function over the rows of each batch."""
    return df.groupBy(batch_col).applyInPandas(fn, schema)
