"""Which checkpoints of a run to keep. Nothing is deleted here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def retained_checkpoints(ckpts: DataFrame, best: DataFrame, limit: int, at_end: bool = False) -> DataFrame:
    """Rows of ``ckpts`` (run_id, step, ...) that a limit keeps.

    The last checkpoint comes first, then the best one (``best``: run_id,
    best_step), then the others by falling step. A limit of 1 keeps two when the
    last is not the best, except at the end of training, when only the best stays.
    A limit of 0 or less keeps all.

    Every kept row is either the best or among the last ``limit`` of its run, so
    the ranking sees a few rows per run whatever a run's length; Spark applies the
    per-run row limit before the shuffle as well.
    """
    if limit <= 0:
        return ckpts
    known = best.select("run_id", F.col("best_step").alias("step")).withColumn("is_best", F.lit(True))
    flagged = ckpts.join(known, ["run_id", "step"], "left").withColumn("is_best", F.coalesce("is_best", F.lit(False)))
    if at_end and limit == 1:
        runs_with_best = known.select("run_id").distinct()
        newest = _last(flagged.join(runs_with_best, "run_id", "left_anti"), 1)
        return flagged.where("is_best").unionByName(newest).drop("is_best")
    candidates = flagged.where("is_best").unionByName(_last(flagged, max(limit, 2)).where(~F.col("is_best")))
    run = Window.partitionBy("run_id")
    last_step = F.max("step").over(run)
    has_best = F.max(F.col("is_best")).over(run)
    ranked = candidates.withColumn("__is_last", F.col("step") == last_step).withColumn("__has_best", has_best)
    priority = F.when(F.col("__is_last"), 0).when(F.col("is_best"), 1).otherwise(2)
    place = F.row_number().over(Window.partitionBy("run_id").orderBy(priority, F.desc("step")))
    allowed = F.lit(limit)
    if limit == 1:
        last_is_best = F.max(F.col("__is_last") & F.col("is_best")).over(run)
        allowed = F.when(F.col("__has_best") & ~last_is_best, 2).otherwise(1)
    kept = ranked.withColumn("__place", place).withColumn("__allowed", allowed)
    return kept.where(F.col("__place") <= F.col("__allowed")).select(*ckpts.columns)


def _last(df: DataFrame, n: int) -> DataFrame:
    newest = Window.partitionBy("run_id").orderBy(F.desc("step"))
    return df.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= n).drop("__r")
