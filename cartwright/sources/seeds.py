"""Reference tables that are part of the warehouse itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Raw product category and the category it is reported under.
CATEGORY_MAP = {
    "running shoes": "Footwear",
    "apparel": "Apparel",
    "bags / urban": "Bags",
    "homewares": "Homewares",
    "bags": "Bags",
    "shoes": "Footwear",
    "accessories": "Accessories",
    "electronics": "Electronics",
}

# US dollars per unit of a currency.
EXCHANGE_RATES = {"USD": "1.0000", "PHP": "0.0178"}


def seed_category_mapping(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{raw}', '{name}')" for raw, name in CATEGORY_MAP.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(category_raw, category_standardized)")


def seed_exchange_rates(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        f"('{currency}', CAST({rate} AS DECIMAL(5,4)))" for currency, rate in EXCHANGE_RATES.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(currency, rate_to_usd)")
