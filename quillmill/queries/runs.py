"""Run logs, best checkpoints and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import columns as c
from quillmill.operators import checkpoints, runlog
from quillmill.queries.base import query, rounded_sql, run_log, runs_sql, table
from quillmill.session import materialize

RUNS = runs_sql()
NAN_RUNS = runs_sql(with_nan=True)


@query("run_log_steps", f"WITH {RUNS} SELECT event_id, run_id, step, loss FROM runs")
def run_log_steps(spark, sf):
    return run_log(spark, sf).select("event_id", "run_id", "step", "loss")


@query(
    "logged_loss",
    f"""WITH {RUNS}, i AS (SELECT *, ceil(step / 10.0)::BIGINT AS interval_id FROM runs)
        , s AS (SELECT run_id, interval_id, max(step) AS last_step, count(*) AS n_steps,
                list_reduce(list(loss ORDER BY step), lambda a, b: a + b) AS total FROM i GROUP BY run_id, interval_id)
        SELECT run_id, interval_id, last_step, n_steps, {rounded_sql("total / n_steps", 4)} AS loss FROM s""",
)
def logged_loss(spark, sf):
    return runlog.logged_loss(run_log(spark, sf), 10)


RECURRENCE = f"""RECURSIVE {NAN_RUNS},
i AS (SELECT run_id, step, loss, ceil(step / 10.0)::BIGINT AS interval_id FROM runs),
walk AS (SELECT run_id, interval_id, step, CASE WHEN isnan(loss) THEN 0.0::DOUBLE ELSE loss END AS acc
         FROM i WHERE step = (interval_id - 1) * 10 + 1
         UNION ALL
         SELECT i.run_id, i.interval_id, i.step,
                CASE WHEN isnan(i.loss) THEN acc + acc / (i.step - (i.interval_id - 1) * 10) ELSE acc + i.loss END
         FROM walk JOIN i ON i.run_id = walk.run_id AND i.interval_id = walk.interval_id AND i.step = walk.step + 1),
sums AS (SELECT run_id, interval_id, arg_max(acc, step) AS loss_sum, count(*) AS n_steps, max(step) AS last_step
         FROM walk GROUP BY run_id, interval_id)"""


@query(
    "logged_loss_nan_filter",
    f"""WITH {RECURRENCE} SELECT run_id, interval_id, last_step, n_steps,
        {rounded_sql("loss_sum / n_steps", 4)} AS loss FROM sums""",
)
def logged_loss_nan_filter(spark, sf):
    return runlog.logged_loss(run_log(spark, sf, with_nan=True), 10, nan_filter=True)


@query(
    "step_losses",
    f"""WITH {RUNS} SELECT run_id, ((step - 1) // 4) + 1 AS step, round(sum(loss) / 4, 6) AS loss
        FROM runs GROUP BY run_id, 2""",
)
def step_losses(spark, sf):
    batches = run_log(spark, sf).withColumn("step", F.floor((F.col("step") - 1) / 4) + 1)
    return runlog.step_losses(batches, 4).withColumn("loss", F.round("loss", 6))


@query(
    "train_loss",
    f"""WITH {RECURRENCE} SELECT run_id, max(last_step) AS steps,
        round(sum(loss_sum) / greatest(max(last_step), 0.001::DOUBLE), 9) AS train_loss FROM sums GROUP BY run_id""",
)
def train_loss(spark, sf):
    out = runlog.train_loss(run_log(spark, sf, with_nan=True), 10, nan_filter=True)
    return out.withColumn("train_loss", F.round("train_loss", 9))


@query(
    "fractional_epoch",
    f"""WITH {RUNS} SELECT run_id, step, {rounded_sql("(step - 1) // 16 + ((step - 1) % 16 + 1) / 16.0::DOUBLE", 2)} AS epoch
        FROM runs""",
)
def fractional_epoch(spark, sf):
    done = F.col("step") - 1
    epoch = c.epoch_of(F.floor(done / 16), done % 16, F.lit(16))
    return run_log(spark, sf).select("run_id", "step", epoch.alias("epoch"))


BEST = """first AS (SELECT run_id, arg_min(step, step) AS fs, arg_min(loss, step) AS fm FROM {t} GROUP BY run_id),
ok AS (SELECT run_id, step, loss, row_number() OVER (PARTITION BY run_id ORDER BY loss {d}, step) AS r
       FROM {t} WHERE NOT isnan(loss)),
best AS (SELECT run_id, CASE WHEN isnan(fm) THEN fs ELSE step END AS best_step,
                CASE WHEN isnan(fm) THEN fm ELSE loss END AS best_metric
         FROM first LEFT JOIN (SELECT * FROM ok WHERE r = 1) USING (run_id))"""


def _best_sql(direction: str) -> str:
    # a NaN compares equal to no number, so results are shown as text
    return f"""WITH {NAN_RUNS}, {BEST.format(t="runs", d=direction)}
        SELECT run_id, best_step, CASE WHEN isnan(best_metric) THEN NULL ELSE best_metric END AS best_metric FROM best"""


def _best(spark, sf, greater):
    log = run_log(spark, sf, with_nan=True).withColumnRenamed("loss", "metric")
    out = runlog.best_checkpoint(log, greater=greater)
    return out.withColumn("best_metric", F.when(~F.isnan("best_metric"), F.col("best_metric")))


@query("best_checkpoint", _best_sql("ASC"))
def best_checkpoint(spark, sf):
    return _best(spark, sf, greater=False)


@query("best_checkpoint_greater", _best_sql("DESC"))
def best_checkpoint_greater(spark, sf):
    return _best(spark, sf, greater=True)


@query(
    "running_best",
    f"""WITH {NAN_RUNS}, w AS (SELECT run_id, step, first_value(loss) OVER s AS f,
               min(CASE WHEN NOT isnan(loss) THEN loss END) OVER s AS b FROM runs
               WINDOW s AS (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING))
        SELECT run_id, step, CASE WHEN isnan(f) THEN NULL ELSE b END AS running_best FROM w""",
)
def running_best(spark, sf):
    log = run_log(spark, sf, with_nan=True).select("run_id", "step", F.col("loss").alias("metric"))
    out = runlog.running_best(log)
    return out.select("run_id", "step", F.when(~F.isnan("running_best"), F.col("running_best")).alias("running_best"))


def _checkpoints(spark, sf):
    path = F.concat(F.lit("runs/"), F.col("run_id"), F.lit("/checkpoint-"), F.col("step"))
    rows = run_log(spark, sf).select("run_id", path.alias("path"), F.col("loss").alias("metric"))
    return materialize(rows, "checkpoints")


@query(
    "checkpoint_steps",
    f"WITH {RUNS} SELECT 'runs/' || run_id || '/checkpoint-' || step AS path, step FROM runs",
)
def checkpoint_steps(spark, sf):
    return _checkpoints(spark, sf).select("path", c.checkpoint_step(F.col("path")).alias("step"))


def _retained_sql(limit: int) -> str:
    return f"""WITH {RUNS}, {BEST.format(t="runs", d="ASC")},
        f AS (SELECT run_id, step, step = max(step) OVER (PARTITION BY run_id) AS is_last, step = best_step AS is_best
              FROM runs JOIN best USING (run_id)),
        o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY
                     CASE WHEN is_last THEN 0 WHEN is_best THEN 1 ELSE 2 END, step DESC) AS place,
                     bool_or(is_last AND is_best) OVER (PARTITION BY run_id) AS same FROM f)
        SELECT run_id, step FROM o WHERE place <= CASE WHEN {limit} = 1 AND NOT same THEN 2 ELSE {limit} END"""


def _retained(spark, sf, limit, at_end=False):
    ckpts = _checkpoints(spark, sf).withColumn("step", c.checkpoint_step(F.col("path")))
    best = runlog.best_checkpoint(ckpts)
    return checkpoints.retained_checkpoints(ckpts, best, limit, at_end).select("run_id", "step")


@query("retained_checkpoints", _retained_sql(3))
def retained_checkpoints(spark, sf):
    return _retained(spark, sf, 3)


@query("retained_checkpoints_limit_one", _retained_sql(1))
def retained_checkpoints_limit_one(spark, sf):
    return _retained(spark, sf, 1)


@query(
    "retained_checkpoints_at_end",
    f"WITH {RUNS}, {BEST.format(t='runs', d='ASC')} SELECT run_id, best_step AS step FROM best",
)
def retained_checkpoints_at_end(spark, sf):
    return _retained(spark, sf, 1, at_end=True)


@query(
    "leaderboard",
    f"""WITH {RUNS} SELECT run_id, arg_max(loss, step) AS objective, max(step) AS last_step FROM runs
        GROUP BY run_id ORDER BY objective, run_id LIMIT 10""",
)
def leaderboard(spark, sf):
    return runlog.leaderboard(run_log(spark, sf).withColumnRenamed("loss", "metric"), 10)


@query(
    "leaderboard_maximize",
    """SELECT user_id AS run_id, arg_max(value, event_id) AS objective, max(event_id) AS last_step FROM events
       GROUP BY user_id ORDER BY objective DESC, run_id LIMIT 5""",
)
def leaderboard_maximize(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("step"), F.col("value").alias("metric")
    )
    return runlog.leaderboard(log, 5, "maximize")
