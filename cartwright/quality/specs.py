"""The checks of the warehouse, as data.

Fixed values: which columns, keys and references are checked, and the ids they report under.
"""

from __future__ import annotations

from dataclasses import dataclass

REQUIRED = {
    "gold.dim_customers": ("customer_sk", "customer_id", "canonical_customer_id", "email"),
    "gold.dim_products": ("product_sk", "product_id", "sku", "product_name"),
    "gold.dim_date": ("date_key", "full_date"),
    "gold.fact_orders": (
        "order_sk", "order_id", "customer_sk", "order_date_key", "order_status", "currency",
        "total_amount",
    ),
    "gold.fact_order_items": (
        "order_item_sk", "order_item_id", "order_sk", "product_sk", "quantity", "unit_price",
    ),
    "gold.fact_payments": (
        "payment_sk", "transaction_id", "order_sk", "payment_method", "status", "currency",
        "gross_amount",
    ),
    "gold.fact_inventory_daily": (
        "inventory_sk", "snapshot_date_key", "product_sk", "warehouse_id", "on_hand_qty",
    ),
    "gold.fact_campaign_performance": (
        "campaign_perf_sk", "campaign_date_key", "platform", "campaign_id", "impressions",
    ),
    "gold.fact_email_engagement": ("email_sk", "send_date_key", "customer_sk", "delivery_status"),
    "gold.fact_purchase_orders": ("po_sk", "po_id", "product_sk", "ordered_qty"),
    "silver.stg_orders": ("order_id", "customer_id", "order_date", "currency"),
    "silver.stg_order_items": ("order_item_id", "order_id", "product_id"),
    "silver.stg_customers": ("customer_id", "email"),
    "silver.stg_products": ("product_id", "sku"),
    "silver.stg_payment_transactions": ("transaction_id", "order_id", "currency"),
}

# Columns with their types; "ID" is the warehouse's identifier type.
SCHEMAS = {
    "gold.dim_customers": (
        ("customer_sk", "ID"), ("customer_id", "ID"), ("canonical_customer_id", "ID"),
        ("email", "VARCHAR"),
    ),
    "gold.dim_products": (
        ("product_sk", "ID"), ("product_id", "ID"), ("sku", "VARCHAR"),
        ("product_name", "VARCHAR"),
    ),
    "gold.fact_orders": (
        ("order_sk", "ID"), ("order_id", "ID"), ("customer_sk", "ID"),
        ("order_date_key", "INTEGER"), ("currency", "VARCHAR"), ("total_amount", "DECIMAL(18,2)"),
        ("total_amount_usd", "DECIMAL(18,2)"),
    ),
    "gold.fact_order_items": (
        ("order_item_sk", "ID"), ("order_sk", "ID"), ("product_sk", "ID"),
        ("quantity", "INTEGER"), ("unit_price", "DECIMAL(18,2)"), ("line_total", "DECIMAL(18,2)"),
    ),
    "gold.fact_payments": (
        ("payment_sk", "ID"), ("transaction_id", "VARCHAR"), ("order_sk", "ID"),
        ("currency", "VARCHAR"), ("gross_amount", "DECIMAL(18,2)"),
    ),
    "gold.fact_inventory_daily": (
        ("inventory_sk", "ID"), ("snapshot_date_key", "INTEGER"), ("product_sk", "ID"),
        ("on_hand_qty", "INTEGER"),
    ),
    "gold.fact_campaign_performance": (
        ("campaign_perf_sk", "ID"), ("campaign_date_key", "INTEGER"), ("platform", "VARCHAR"),
        ("impressions", "INTEGER"),
    ),
    "gold.fact_email_engagement": (
        ("email_sk", "ID"), ("send_date_key", "INTEGER"), ("customer_sk", "ID"),
        ("delivery_status", "VARCHAR"),
    ),
    "gold.fact_purchase_orders": (
        ("po_sk", "ID"), ("po_id", "ID"), ("product_sk", "ID"), ("ordered_qty", "INTEGER"),
    ),
}

UNIQUE = {
    "gold.fact_orders": ("order_id", "order_sk"),
    "gold.fact_order_items": ("order_item_id", "order_item_sk"),
    "gold.fact_payments": ("transaction_id", "payment_sk"),
    "gold.fact_campaign_performance": ("campaign_perf_sk",),
    "gold.fact_email_engagement": ("email_sk",),
    "gold.fact_purchase_orders": ("po_id", "po_sk"),
    "gold.fact_inventory_daily": ("inventory_sk",),
    "gold.dim_customers": ("customer_sk",),
    "gold.dim_products": ("product_sk",),
    "silver.stg_orders": ("order_id",),
    "silver.stg_order_items": ("order_item_id",),
    "silver.stg_payment_transactions": ("transaction_id",),
}

# Child column, parent table, parent column.
REFERENCES = {
    "gold.fact_orders": (
        ("customer_sk", "gold.dim_customers", "customer_sk"),
        ("order_date_key", "gold.dim_date", "date_key"),
    ),
    "gold.fact_order_items": (
        ("order_sk", "gold.fact_orders", "order_sk"),
        ("product_sk", "gold.dim_products", "product_sk"),
    ),
    "gold.fact_payments": (
        ("order_sk", "gold.fact_orders", "order_sk"),
        ("payment_date_key", "gold.dim_date", "date_key"),
    ),
    "gold.fact_inventory_daily": (
        ("product_sk", "gold.dim_products", "product_sk"),
        ("snapshot_date_key", "gold.dim_date", "date_key"),
    ),
    "gold.fact_campaign_performance": (("campaign_date_key", "gold.dim_date", "date_key"),),
    "gold.fact_email_engagement": (
        ("customer_sk", "gold.dim_customers", "customer_sk"),
        ("send_date_key", "gold.dim_date", "date_key"),
    ),
    "gold.fact_purchase_orders": (
        ("product_sk", "gold.dim_products", "product_sk"),
        ("created_date_key", "gold.dim_date", "date_key"),
    ),
}


@dataclass(frozen=True)
class RowRule:
    """A row fails when ``fails`` is true; NULL does not fail."""

    check_id: str
    category: str
    table: str
    description: str
    fails: str


def _cents(check: str, table: str, left: str, right: str, only: str = "") -> RowRule:
    """``left`` and ``right`` may differ by one cent."""
    gap = f"abs({left} - ({right})) > CAST(0.01 AS DECIMAL(18,2))"
    return RowRule(
        f"arith_{check}",
        "arithmetic",
        f"gold.{table}",
        f"{left} = {right} within 0.01",
        f"{only} AND {gap}" if only else gap,
    )


# Ids, texts and conditions of the remaining row checks.
ROW_RULES = (
    RowRule(
        "currency_usd_conversion_positive",
        "currency",
        "gold.fact_orders",
        "positive amounts stay positive in USD",
        "total_amount > 0 AND total_amount_usd <= 0",
    ),
    _cents(
        "order_total",
        "fact_orders",
        "total_amount",
        "subtotal_amount - discount_amount + shipping_amount + tax_amount",
    ),
    _cents("line_total", "fact_order_items", "line_total", "unit_price * quantity - discount_amount"),
    _cents(
        "payment_net",
        "fact_payments",
        "net_amount",
        "gross_amount - fee_amount",
        "transaction_type NOT IN ('void', 'authorization')",
    ),
    _cents("gross_profit", "fact_order_items", "gross_profit", "line_total - unit_cost * quantity"),
    _cents("po_total", "fact_purchase_orders", "po_total", "ordered_qty * unit_cost"),
)

# Columns that must not be negative.
NON_NEGATIVE = {
    "gold.fact_orders": ("total_amount", "total_amount_usd"),
    "gold.fact_order_items": ("unit_price",),
    "gold.fact_payments": ("gross_amount",),
    "gold.fact_inventory_daily": ("inventory_value",),
}


def row_rules() -> list[RowRule]:
    """All checks that look at one row at a time: required, arithmetic, non-negative."""
    required = [
        RowRule(f"null_{table}.{c}", "null", table, f"{c} NOT NULL", f"`{c}` IS NULL")
        for table, columns in REQUIRED.items()
        for c in columns
    ]
    signs = [
        RowRule(
            f"arith_nonneg_{table}.{c}", "arithmetic", table, f"{c} >= 0", f"`{c}` < 0"
        )
        for table, columns in NON_NEGATIVE.items()
        for c in columns
    ]
    return [*required, *ROW_RULES, *signs]
