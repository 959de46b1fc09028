"""Analytics over a run log: one row per run and step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions.columns import is_nonfinite, round_binary
from quillmill.operators import ordering as o


def step_losses(batches: DataFrame, accum: int, by: Sequence[str] = ("run_id", "step")) -> DataFrame:
    """Loss of every optimizer step: its micro-batch losses over the accumulation."""
    return batches.groupBy(*by).agg((F.sum("loss") / accum).alias("loss"))


def _interval(every: int):
    return F.ceil(F.col("step") / every)


def interval_sums(log: DataFrame, every: int, nan_filter: bool = False) -> DataFrame:
    """Loss sum and number of steps of every logging interval of every run.

    Losses are added in step order, so that the sum is the same in every run of
    the job. With ``nan_filter`` a NaN or infinite loss is replaced by the sum so
    far over (1 + steps taken since the last log). An interval holds at most
    ``every`` rows, the bound of the collected list.
    """
    tagged = log.select("run_id", "step", "loss", _interval(every).alias("interval_id"))
    listed = tagged.groupBy("run_id", "interval_id").agg(
        F.array_sort(F.collect_list(F.struct("step", "loss"))).alias("__steps"),
        F.count(F.lit(1)).alias("n_steps"),
        F.max("step").alias("last_step"),
    )
    logged_until = (F.col("interval_id") - 1) * every
    total = F.aggregate(
        "__steps",
        F.lit(0.0),
        lambda acc, x: F.when(
            F.lit(nan_filter) & is_nonfinite(x["loss"]),
            # the step counter is still at step - 1 while step is being computed
            acc + acc / (x["step"] - logged_until),
        ).otherwise(acc + x["loss"]),
    )
    return listed.select("run_id", "interval_id", total.alias("loss_sum"), "n_steps", "last_step")


def logged_loss(log: DataFrame, every: int, nan_filter: bool = False) -> DataFrame:
    """Loss as logged: mean over the steps since the last log, rounded to 4 places."""
    mean = round_binary(F.col("loss_sum") / F.col("n_steps"), 4)
    return interval_sums(log, every, nan_filter).select(
        "run_id", "interval_id", "last_step", "n_steps", mean.alias("loss")
    )


def train_loss(log: DataFrame, every: int, nan_filter: bool = False) -> DataFrame:
    """Final loss of a run: all logged sums over the number of steps."""
    sums = interval_sums(log, every, nan_filter)
    return sums.groupBy("run_id").agg(
        F.max("last_step").alias("steps"),
        (F.sum("loss_sum") / F.greatest(F.max("last_step").cast("double"), F.lit(0.001))).alias("train_loss"),
    )


def metric_name(name: str) -> str:
    return name if name.startswith("eval_") else f"eval_{name}"


def with_metric(log: DataFrame, metric: str, out: str = "metric") -> DataFrame:
    """Records of a log (map column ``metrics``) that hold a metric."""
    value = F.col("metrics")[metric_name(metric)]
    return log.withColumn(out, value).where(F.col(out).isNotNull()).drop("metrics")


def _best(greater: bool, metric: str):
    """(metric, step) of the best record as an aggregate; the earliest wins a tie."""
    m, step = F.col(metric), F.col("step")
    comparable = F.when(m.isNotNull() & ~F.isnan(m), F.struct(m.alias("m"), (-step if greater else step).alias("s")))
    return F.max(comparable) if greater else F.min(comparable)


def best_checkpoint(log: DataFrame, metric: str = "metric", greater: bool = False) -> DataFrame:
    """Step and metric of the best record of every run.

    Only a strictly better value replaces the best. A NaN never does; but a NaN in
    the first record stays, since nothing compares as better than it. Records without
    a metric don't count; a run of such records only has no best.
    """
    first = F.min(F.when(F.col(metric).isNotNull(), F.struct(F.col("step").alias("s"), F.col(metric).alias("m"))))
    grouped = log.groupBy("run_id").agg(first.alias("f"), _best(greater, metric).alias("b"))
    stuck = F.coalesce(F.isnan("f.m"), F.lit(False))
    step = F.when(stuck, F.col("f.s")).otherwise(F.abs("b.s"))
    return grouped.select(
        "run_id", step.alias("best_step"), F.when(stuck, F.col("f.m")).otherwise(F.col("b.m")).alias("best_metric")
    )


def running_best(log: DataFrame, metric: str = "metric", greater: bool = False) -> DataFrame:
    """Best metric so far at every record, by the rules of :func:`best_checkpoint`."""
    m = F.col(metric)
    fn = "max" if greater else "min"
    out = o.running(
        log,
        ["step"],
        {
            "__first": ("min", F.when(m.isNotNull(), F.struct(F.col("step").alias("s"), m.alias("m")))),
            "running_best": (fn, F.when(~F.isnan(m), m)),
        },
        ["run_id"],
    )
    stuck = F.coalesce(F.isnan("__first.m"), F.lit(False))
    return out.withColumn("running_best", F.when(stuck, F.col("__first.m")).otherwise(F.col("running_best"))).drop(
        "__first"
    )


def leaderboard(log: DataFrame, k: int, direction: str = "minimize", metric: str = "metric") -> DataFrame:
    """The ``k`` best runs by their last recorded objective; NaN comes last in both directions.

    Records without an objective don't count, nor do runs that have none.
    """
    if direction not in ("minimize", "maximize"):
        raise ValueError(f"direction is 'minimize' or 'maximize', not {direction!r}")
    last = log.where(F.col(metric).isNotNull()).groupBy("run_id").agg(
        F.max_by(metric, "step").alias("objective"),
        F.max("step").alias("last_step"),
    )
    order = F.asc("objective") if direction == "minimize" else F.desc("objective")
    return last.orderBy(F.isnan("objective"), order, "run_id").limit(k)
