from datetime import datetime

from cartwright import history

TASK = """pipeline_run_id string, dag_id string, task_id string, status string,
    start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds string, attempts int,
    error string"""


def at(minute):
    return datetime(2026, 3, 10, 2, minute)


ROWS = [
    ("r1", "daily", "ingest", "success", at(0), at(1), "60.0", 1, None),
    ("r1", "daily", "build", "failed", at(1), at(4), "180.5", 3, "x" * 600),
    ("r2", "daily", "ingest", "success", at(0), at(2), "bad", 1, ""),
    ("r3", "daily", "ingest", "success", at(0), at(2), "20.0", 1, ""),
]


def tasks(spark):
    return spark.createDataFrame(ROWS, TASK)


def test_runs(spark):
    runs = history.run_history(tasks(spark))
    first = {r.pipeline_run_id: r for r in runs.collect()}["r1"]
    assert (first.total_tasks, first.succeeded, first.failed, first.elapsed_seconds) == (2, 1, 1, 240.0)
    assert tuple(history.run_success_rate(runs).first()) == (3, 1, 67.0)


def test_durations_skip_unreadable_values(spark):
    result = {r.task_id: (r.avg_seconds, r.runs) for r in history.task_durations(tasks(spark)).collect()}
    assert result == {"ingest": (40.0, 2), "build": (180.5, 1)}


def test_failures_and_appending(spark, tmp_path):
    (failure,) = history.failure_log(tasks(spark)).collect()
    assert (failure.task_id, len(failure.error)) == ("build", 600)
    for _ in range(2):
        history.append_task_history(tasks(spark), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/tasks").count() == 8
    failures = spark.read.parquet(f"{tmp_path}/failures")
    assert failures.count() == 2 and failures.where("failure_ts IS NULL").count() == 0
    assert "run_ts" in spark.read.parquet(f"{tmp_path}/tasks").columns


def volumes(spark, rows):
    log = spark.createDataFrame(rows, "source string, status string, rows_ingested long")
    return {r.source: r.rows_ingested for r in history.volume_by_source(log).collect()}


def test_volumes(spark):
    rows = [("a", "success", 5), ("a", "failed", 100), ("b", "success", 7)]
    assert volumes(spark, rows) == {"a": 5, "b": 7, "TOTAL": 12}
    # Without any success all loads are shown.
    assert volumes(spark, [("a", "failed", 3), ("b", None, 4)]) == {"a": 3, "b": 4, "TOTAL": 7}


def test_trend(spark):
    rows = [("r1", 8, 7, 1), ("r2", 0, 0, 0)]
    df = spark.createDataFrame(rows, "run_id string, total long, passed long, failed long")
    assert {r.run_id: r.pass_rate_pct for r in history.dq_trend(df).collect()} == {"r1": 88.0, "r2": None}
