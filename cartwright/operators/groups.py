"""Per-group operators that never gather a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, newest_by: str) -> DataFrame:
    """One row per key: the newest, and among equally new ones the first by all columns.

    Asking for rank 1 lets Spark keep one row per key before the shuffle, so many copies
    of one key cost no more than one.
    """
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in (key, newest_by)]
    newest = Window.partitionBy(key).orderBy(F.col(newest_by).desc_nulls_last(), *ties)
    return (
        df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
    )


def flag_repeated(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add flag ``name``: does ``column`` have the same value in another row? NULLs are alike.

    Counts are aggregated map-side and only the repeated values are joined back, which
    replaces a count window over whole groups.
    """
    repeated = (
        df.groupBy(F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select("_value", F.lit(True).alias(name))
    )
    joined = df.join(repeated, F.col(column).eqNullSafe(F.col("_value")), "left")
    return joined.select(*df.columns, F.coalesce(F.col(name), F.lit(False)).alias(name))


def group_minimum(
    df: DataFrame, group: str, value: str, name: str, repeated: Column | None = None
) -> DataFrame:
    """Add the least ``value`` of each row's group; rows with a NULL group are dropped.

    Where ``repeated`` tells which groups have several rows, only those are aggregated and
    joined: in the others the least value is the row's own.
    """
    rows = df.where(F.col(group).isNotNull())
    least = (rows if repeated is None else rows.where(repeated)).groupBy(group).agg(
        F.min(value).alias(name)
    )
    if repeated is None:
        return rows.join(least, group, "inner").select(*df.columns, name)
    joined = rows.join(least, group, "left")
    own = F.when(repeated, F.col(name)).otherwise(F.col(value))
    return joined.select(*df.columns, own.alias(name))
