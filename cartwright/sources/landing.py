"""Dated landing zone: ``root/source/entity/dt=YYYY-MM-DD``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.sources.entities import Entity

RECORDS_PER_FILE = 5_000_000


class EmptyExtractError(ValueError):
    """An extract without rows must not replace a partition."""


def entity_path(root: str, entity: Entity) -> str:
    return f"{root.rstrip('/')}/{entity.source}/{entity.name}"


def land(df: DataFrame, root: str, entity: Entity, dt: str) -> int:
    """Replace one ``dt`` partition and return its row count.

    The rows are counted while they are written. Only partitions that get rows are replaced, so
    an empty extract, which is refused, has touched nothing.
    """
    seen = Observation()
    write_day(df.observe(seen, F.count(F.lit(1)).alias("rows")), root, entity, dt)
    return refuse_empty(seen.get["rows"], entity, dt)


def write_day(df: DataFrame, root: str, entity: Entity, dt: str) -> None:
    _write(df.withColumn("dt", F.lit(dt)), entity_path(root, entity))


def refuse_empty(rows: int, entity: Entity, dt: str) -> int:
    if not rows:
        raise EmptyExtractError(f"{entity.key} has no rows for {dt}; nothing was written")
    return rows


def land_days(df: DataFrame, root: str, entity: Entity, day: Column) -> None:
    """Land many days at once, replacing exactly the partitions present in ``df``.

    The rebalance hint brings the rows of a day together, merges small days into one task
    and splits a day that is too large for one.
    """
    dated = df.withColumn("dt", F.date_format(day, "yyyy-MM-dd"))
    _write(dated.hint("rebalance", "dt"), entity_path(root, entity))


def _write(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .partitionBy("dt")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .parquet(path)
    )


def read_landed(
    spark: SparkSession, root: str, entity: Entity, days: list[str] | None = None, others: list[str] | None = None
) -> DataFrame:
    """Landed days of an entity, all by default, with ``dt`` as text.

    Registered columns come first, then those that only some days have (null in the others), as text. Which these are
    is taken from the load log where given (``others``, see ``loads.other_columns``), else from the footers
    of the days that are read.
    """
    path = entity_path(root, entity)
    known = {f.name for f in entity.schema} | {"dt"}
    if others is None:
        paths = [f"{path}/dt={dt}" for dt in days] if days else [path]
        found = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*paths).schema
        others = [f.name for f in found if f.name not in known]
    more = [T.StructField(c, T.StringType()) for c in others if c not in known]
    schema = T.StructType([*entity.schema.fields, *more, T.StructField("dt", T.StringType())])
    landed = spark.read.schema(schema).parquet(path)
    return landed.where(F.col("dt").isin(days)) if days else landed


def read_partition(
    spark: SparkSession, root: str, entity: Entity, dt: str, others: list[str] | None = None
) -> DataFrame:
    """Rows of one landed day; the filter prunes every other partition."""
    return read_landed(spark, root, entity, [dt], others).drop("dt")


def bronze(spark: SparkSession, root: str, entities, dt: str) -> dict[str, DataFrame]:
    """The bronze tables of one day, by table name, with all columns that were landed."""
    return {e.table: read_partition(spark, root, e, dt) for e in entities}
