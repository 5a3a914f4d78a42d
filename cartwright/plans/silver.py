"""Staging models: one typed, normalised table per bronze table.

``id_type`` is the type of identifiers: ``int`` by default, ``bigint`` for tables whose ids
or row counts pass two billion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import (
    clean_text,
    empty_to_null,
    lower_text,
    money,
    phone_text,
    ratio,
    round_half_away,
    upper_text,
    utc_datetime,
)
from cartwright.operators import flag_repeated, keep_latest, lookup

TOLERANCE = "0.01"


class _Columns:
    """Named, typed columns of one bronze table."""

    def __init__(self, df: DataFrame, id_type: str):
        self.df, self.id_type = df, id_type

    def ids(self, *names: str) -> list[Column]:
        return [F.col(n).cast(self.id_type).alias(n) for n in names]

    def ints(self, *names: str) -> list[Column]:
        return [F.col(n).cast("int").alias(n) for n in names]

    def texts(self, *names: str) -> list[Column]:
        return [clean_text(F.col(n)).alias(n) for n in names]

    def lower(self, *names: str) -> list[Column]:
        return [lower_text(F.col(n)).alias(n) for n in names]

    def upper(self, *names: str) -> list[Column]:
        return [upper_text(F.col(n)).alias(n) for n in names]

    def monies(self, *names: str) -> list[Column]:
        return [money(F.col(n)).alias(n) for n in names]

    def flags(self, *names: str) -> list[Column]:
        return [F.col(n).cast("boolean").alias(n) for n in names]

    def dates(self, *names: str) -> list[Column]:
        return [utc_datetime(self.df, n).cast("date").alias(n) for n in names]

    def times(self, *names: str) -> list[Column]:
        return [utc_datetime(self.df, n).alias(n) for n in names]


def _differs(expected: Column, actual: Column) -> Column:
    return F.abs(expected - actual) > F.lit(TOLERANCE).cast("decimal(18,2)")


def _amounts(exact: bool, *names: str) -> list[Column]:
    """Amounts as exact money, or as doubles."""
    return [money(F.col(n)) if exact else F.col(n).cast("double") for n in names]


def stg_customers(customers: DataFrame, id_type: str = "int", phone_digits: bool = False):
    """Newest row per customer, normalised, with a flag for e-mails of several customers."""
    c = _Columns(customers, id_type)
    rows = keep_latest(customers, "customer_id", "created_at").select(
        *c.ids("customer_id"),
        *c.lower("email"),
        *c.texts("first_name", "last_name"),
        phone_text(F.col("phone"), phone_digits).alias("phone"),
        *c.times("created_at"),
        *c.upper("country_code"),
        *c.lower("status"),
        *c.flags("marketing_opt_in"),
    )
    return flag_repeated(rows, "email", "is_duplicate_email")


def stg_products(products: DataFrame, category_mapping: DataFrame, id_type: str = "int"):
    """Products with their reporting category and gross margin in percent."""
    c = _Columns(products, id_type)
    cost, price = F.col("unit_cost").cast("double"), F.col("list_price").cast("double")
    margin = round_half_away(ratio(price - cost, price) * 100, 2)
    raw = lower_text(F.col("category"))
    mapped = lookup(
        products.withColumn("_raw", raw),
        category_mapping,
        "_raw",
        "category_raw",
        {"category_standardized": "_standard"},
        fixed_size=True,
    )
    return mapped.select(
        *c.ids("product_id"),
        *c.texts("sku", "product_name"),
        F.col("_raw").alias("category_raw"),
        F.coalesce("_standard", F.lit("Uncategorized")).alias("category_standardized"),
        *c.texts("brand"),
        *c.monies("unit_cost", "list_price"),
        margin.alias("gross_margin_pct"),
        *c.flags("is_active"),
        *c.times("created_at"),
    )


def stg_orders(orders: DataFrame, id_type: str = "int", exact: bool = True):
    """Orders; ``exact=False`` compares the total in doubles, where a gap of one cent may show."""
    c = _Columns(orders, id_type)
    subtotal, discount, shipping, tax, total = _amounts(
        exact, "subtotal_amount", "discount_amount", "shipping_amount", "tax_amount", "total_amount"
    )
    return orders.select(
        *c.ids("order_id", "customer_id"),
        *c.times("order_date"),
        *c.lower("order_status"),
        *c.upper("currency"),
        *c.monies(
            "subtotal_amount", "discount_amount", "shipping_amount", "tax_amount", "total_amount"
        ),
        _differs(subtotal - discount + shipping + tax, total).alias("has_total_mismatch"),
        *c.lower("payment_status"),
        *c.ids("shipping_address_id", "billing_address_id"),
        *c.times("updated_at"),
    )


def stg_order_items(items: DataFrame, id_type: str = "int", exact: bool = True):
    c = _Columns(items, id_type)
    price, discount, total = _amounts(exact, "unit_price", "discount_amount", "line_total")
    quantity = F.col("quantity").cast("int" if exact else "double")
    return items.select(
        *c.ids("order_item_id", "order_id", "product_id"),
        *c.texts("sku", "product_name"),
        *c.ints("quantity"),
        *c.monies("unit_price", "discount_amount", "line_total"),
        _differs(price * quantity - discount, total).alias("has_line_total_mismatch"),
    )


def stg_payment_transactions(payments: DataFrame, id_type: str = "int"):
    c = _Columns(payments, id_type)
    return payments.select(
        *c.texts("transaction_id"),
        *c.ids("order_id", "customer_id"),
        *c.lower("payment_method", "transaction_type", "status"),
        *c.upper("currency"),
        *c.monies("gross_amount", "fee_amount", "net_amount"),
        *c.times("provider_created_at"),
        empty_to_null(lower_text(F.col("card_brand"))).alias("card_brand"),
        empty_to_null(upper_text(F.col("card_country"))).alias("card_country"),
        empty_to_null(clean_text(F.col("failure_reason"))).alias("failure_reason"),
        *c.flags("refund_flag"),
    )


def stg_campaign_performance(campaigns: DataFrame, id_type: str = "int"):
    c = _Columns(campaigns, id_type)
    return campaigns.select(
        *c.dates("campaign_date"),
        *c.lower("platform"),
        *c.texts("campaign_id", "campaign_name"),
        *c.lower("channel"),
        *c.ints("impressions", "clicks"),
        *c.monies("spend"),
        *c.ints("conversions"),
        *c.monies("reported_revenue"),
        *c.upper("country_code"),
        *c.lower("device_type"),
        *c.texts("load_filename"),
        *c.times("loaded_at"),
    )


def stg_email_sends(sends: DataFrame, id_type: str = "int"):
    c = _Columns(sends, id_type)
    return sends.select(
        *c.dates("send_date"),
        *c.texts("campaign_id", "campaign_name"),
        *c.lower("recipient_email"),
        *c.ids("customer_id"),
        *c.lower("delivery_status"),
        *c.flags("open_flag", "click_flag", "unsubscribe_flag"),
        *c.texts("load_filename"),
        *c.times("loaded_at"),
    )


def stg_inventory_snapshot(snapshots: DataFrame, id_type: str = "int"):
    c = _Columns(snapshots, id_type)
    return snapshots.select(
        *c.dates("snapshot_date"),
        *c.ints("warehouse_id"),
        *c.texts("sku"),
        *c.ids("product_id"),
        *c.ints("on_hand_qty", "reserved_qty", "available_qty", "reorder_point"),
        *c.monies("unit_cost"),
    )


def stg_purchase_orders(purchase_orders: DataFrame, id_type: str = "int"):
    c = _Columns(purchase_orders, id_type)
    return purchase_orders.select(
        *c.ids("po_id", "supplier_id"),
        *c.texts("sku"),
        *c.ints("ordered_qty", "received_qty"),
        *c.monies("unit_cost"),
        *c.lower("po_status"),
        *c.times("created_at"),
        *c.dates("expected_delivery_date"),
    )


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the newest snapshot day, for landing zones that hold several days."""
    newest = snapshots.agg(F.max("snapshot_date").alias("snapshot_date"))  # one row
    return snapshots.join(F.broadcast(newest), "snapshot_date", "left_semi").select(
        *snapshots.columns
    )
