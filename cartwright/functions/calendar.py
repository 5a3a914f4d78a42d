"""Date and time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utc_datetime(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as a UTC wall-clock ``timestamp_ntz``.

    A zoned instant is rebuilt from its microseconds, so the session zone plays no part.
    """
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.expr(
            f"timestampadd(MICROSECOND, unix_micros(`{name}`), TIMESTAMP_NTZ '1970-01-01 00:00:00')"
        )
    return F.col(name).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """Day as the whole number yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")

