"""Check reports: totals, history and the newest failures."""

from __future__ import annotations

from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ChecksFailed(RuntimeError):
    """At least one check failed."""


def summary(results: DataFrame, *by: str) -> DataFrame:
    """Totals per report: checks, passed, failed, pass rate and whether all passed."""
    counts = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed")
    )
    return counts.select(
        *by,
        "total",
        "passed",
        (F.col("total") - F.col("passed")).alias("failed"),
        (F.col("passed") == F.col("total")).alias("all_passed"),
    )


def append_report(
    results: DataFrame,
    folder: str,
    run_id: str | None = None,
    run_ts: datetime | None = None,
    must_pass: bool = False,
) -> DataFrame:
    """Store a report and its totals; return the stored report.

    Check rows go to ``folder/checks`` as JSON, one partition per run, and the totals to
    ``folder/history`` as CSV. A report has one row per check, so one task writes it.
    """
    now = run_ts or datetime.now(timezone.utc)
    run_id = run_id or now.strftime("%Y%m%dT%H%M%S")
    spark = results.sparkSession
    schema = results.schema
    stamped = results.withColumn("run_id", F.lit(run_id))
    checks = f"{folder}/checks"
    (
        stamped.repartition(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .json(checks)
    )
    stored = spark.read.schema(schema.add("run_id", "string")).json(checks)
    this_run = stored.where(F.col("run_id") == run_id)
    totals = summary(this_run, "run_id").select(
        "run_id", F.lit(now.isoformat()).alias("run_ts"), "total", "passed", "failed"
    )
    totals.coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/history")
    if must_pass and not this_run.where(~F.col("passed")).isEmpty():
        raise ChecksFailed(f"report {run_id} has failed checks, see {checks}")
    return this_run


def report_runs(spark: SparkSession, folder: str) -> list[str]:
    """Run ids of the stored reports, from the names of their partitions; no report is read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/checks")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted(unquote(n.removeprefix("run_id=")) for n in names if n.startswith("run_id="))


def newest_report(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The checks of the newest stored run: one partition is scanned, however many reports there are.

    ``schema`` are the columns of a report without its run id. Without reports the result is empty.
    """
    runs = report_runs(spark, folder)
    shape = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    if not runs:
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).json(f"{folder}/checks").where(F.col("run_id") == runs[-1])


def latest_failures(reports: DataFrame) -> DataFrame:
    """Failed checks of the newest report, by run id."""
    newest = reports.agg(F.max("run_id").alias("run_id"))  # one row
    return reports.where(~F.col("passed")).join(F.broadcast(newest), "run_id", "left_semi")
