"""Roll-ups over run, task, load and check histories."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions import ratio, round_half_away


def task_history(tasks: DataFrame) -> DataFrame:
    """Task rows as they are stored: with the whole error text, empty where there is none."""
    return tasks.withColumn("error", F.coalesce("error", F.lit("")))


def failure_log(tasks: DataFrame) -> DataFrame:
    """Tasks that did not succeed."""
    return task_history(tasks.where(F.col("status") != "success")).select(
        "pipeline_run_id", "dag_id", "task_id", "status", "attempts", "error"
    )


def append_task_history(tasks: DataFrame, folder: str, written_at: datetime | None = None) -> None:
    """Append to ``folder/tasks``, and what failed to ``folder/failures``.

    ``written_at`` is kept as ``run_ts`` of the tasks and ``failure_ts`` of the failures.
    """
    stamp = F.lit(written_at or datetime.now(timezone.utc))
    task_history(tasks).withColumn("run_ts", stamp).write.mode("append").parquet(f"{folder}/tasks")
    failures = failure_log(tasks).withColumn("failure_ts", stamp)
    failures.write.mode("append").parquet(f"{folder}/failures")


def run_history(tasks: DataFrame) -> DataFrame:
    """Per run: tasks, succeeded, failed and the time from first start to last end."""
    ok = F.col("status") == "success"
    span = F.expr("timestampdiff(MICROSECOND, min(start_time), max(end_time))")
    return tasks.groupBy("pipeline_run_id", "dag_id").agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        round_half_away(span / 1e6, 3).alias("elapsed_seconds"),
    )


def run_success_rate(runs: DataFrame) -> DataFrame:
    """One row: runs, runs with a failed task, and the share without, in percent."""
    counts = runs.agg(
        F.count(F.lit(1)).alias("total_runs"), F.count_if(F.col("failed") > 0).alias("failed_runs")
    )
    good = F.col("total_runs") - F.col("failed_runs")
    return counts.withColumn("success_rate_pct", F.rint(ratio(good, F.col("total_runs")) * 100))


def task_durations(tasks: DataFrame) -> DataFrame:
    """Mean duration and number of runs per task; unreadable durations are skipped."""
    seconds = F.col("duration_seconds").try_cast("decimal(28,9)")
    timed = tasks.select("task_id", seconds.alias("_s")).where(F.col("_s").isNotNull())
    sums = timed.groupBy("task_id").agg(
        F.sum("_s").alias("_total"), F.count(F.lit(1)).alias("runs")
    )
    return sums.select(
        "task_id", ratio(F.col("_total"), F.col("runs"), 3).alias("avg_seconds"), "runs"
    )


def ingestion_volumes(log: DataFrame) -> DataFrame:
    """Successful loads; if there are none, all loads."""
    status = F.col("status") == "success"
    any_success = log.agg(F.coalesce(F.bool_or(status), F.lit(False)).alias("_any"))  # one row
    # Without any success every row has _ok = false, which then equals _any.
    flagged = log.withColumn("_ok", F.coalesce(status, F.lit(False)))
    return flagged.join(F.broadcast(any_success), F.col("_ok") == F.col("_any")).drop("_ok", "_any")


def volume_by_source(log: DataFrame) -> DataFrame:
    """Rows loaded per source, with a grand total in the row whose source is ``TOTAL``."""
    sums = (
        ingestion_volumes(log)
        .rollup("source")
        .agg(F.sum("rows_ingested").alias("rows_ingested"), F.grouping("source").alias("_all"))
    )
    name = F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col("source"))
    rows = F.coalesce("rows_ingested", F.lit(0))
    return sums.select(name.alias("source"), rows.alias("rows_ingested"))


def dq_trend(history: DataFrame) -> DataFrame:
    """Pass rate per check report in whole percent, NULL for a report without checks."""
    rate = F.rint(ratio(F.col("passed"), F.col("total")) * 100)
    return history.select("run_id", "total", "passed", "failed", rate.alias("pass_rate_pct"))
