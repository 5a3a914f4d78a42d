"""Dimension models."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions import date_key
from cartwright.operators import dense_key, group_minimum
from cartwright.sources.scratch import Scratch

FIRST_DAY, LAST_DAY = date(2024, 1, 1), date(2027, 12, 31)


def stamp(moment: datetime | None) -> Column:
    """Audit column: the given moment, or the start of the query."""
    return F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")


def calendar_days(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day, both ends included."""
    length = (last - first).days + 1
    return spark.range(length).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")
    )


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes; weeks are ISO weeks and the fiscal year starts in July."""
    day = F.col("full_date")
    month, quarter, year = F.month(day), F.quarter(day), F.year(day)
    iso_day = F.weekday(day) + 1
    second_half = month >= 7
    return days.select(
        date_key(day).alias("date_key"),
        day,
        iso_day.cast("int").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        month.alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        quarter.alias("quarter"),
        year.alias("year"),
        (iso_day >= 6).alias("is_weekend"),
        F.when(second_half, quarter - 2).otherwise(quarter + 2).cast("int").alias("fiscal_quarter"),
        F.when(second_half, year + 1).otherwise(year).cast("int").alias("fiscal_year"),
    )


def dim_customers(
    stg_customers: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Customers with the lowest id sharing their e-mail; customers without e-mail are left out.

    The validity columns are constant: every row is current.
    """
    rows = group_minimum(
        stg_customers,
        "email",
        "customer_id",
        "canonical_customer_id",
        repeated=F.col("is_duplicate_email"),
    )
    ids = stg_customers.select(F.col("customer_id").alias("canonical_customer_id"))
    order = ["canonical_customer_id", "customer_id"]
    keyed = dense_key(rows, order, "customer_sk", scratch, key_type, narrow=ids)
    return keyed.select(
        "customer_sk",
        "customer_id",
        "canonical_customer_id",
        "email",
        "first_name",
        "last_name",
        "phone",
        "country_code",
        "status",
        "marketing_opt_in",
        "created_at",
        "is_duplicate_email",
        F.lit(True).alias("is_current"),
        F.col("created_at").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        stamp(loaded_at).alias("_loaded_at"),
    )


def dim_products(
    stg_products: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    ties = [c for c in stg_products.columns if c != "product_id"]
    keyed = dense_key(stg_products, ["product_id", *ties], "product_sk", scratch, key_type)
    return keyed.withColumn("_loaded_at", stamp(loaded_at))
