"""Fact models: staging rows with surrogate keys of their dimensions.

Every fact ends with a dense key over its natural key, extended by further columns so that
the numbering is fixed by the data alone.
"""

from __future__ import annotations

from datetime import date, datetime
from itertools import takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import money, ratio, to_usd
from cartwright.operators import dense_key, lookup, lookup_number, with_row_tag
from cartwright.operators.dense_key import ROW_TAG
from cartwright.plans.dims import stamp
from cartwright.sources.scratch import Scratch


def _day(df: DataFrame, dim_date: DataFrame, day: Column, name: str) -> DataFrame:
    return lookup(df, dim_date, day, "full_date", {"date_key": name}, fixed_size=True)


def _customer(df: DataFrame, dim_customers: DataFrame) -> DataFrame:
    current = dim_customers.where("is_current")
    return lookup(df, current, "customer_id", "customer_id", {"customer_sk": "customer_sk"})


def _rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    return lookup(df, rates, "currency", "currency", {"rate_to_usd": "_rate"}, fixed_size=True)


def _finish(
    df: DataFrame,
    columns: list,
    order_by: list,
    name: str,
    scratch: Scratch,
    key_type: str,
    loaded_at: datetime | None,
    staged: DataFrame,
    derived: dict[str, Column],
) -> DataFrame:
    """Number the rows and keep ``columns``.

    Rows equal in ``order_by`` are told apart by their remaining columns. The ranges of the
    order's first columns come from ``staged``, before anything is joined to it. ``derived`` are those of the columns
    that follow from columns before them: they settle no order, so they are computed where the fact is read and
    neither shuffled nor written.
    """
    stored = [c for c in columns if not (isinstance(c, str) and c in derived)]
    kept = df.select(*stored).columns
    hidden = [c for c in order_by if c not in kept]
    shaped = df.select(*stored, *hidden, ROW_TAG)
    order = order_by + [c for c in kept if c not in order_by]
    first = list(takewhile(staged.columns.__contains__, order_by))
    narrow = staged.select(*first) if first else None
    keyed = dense_key(shaped, order, name, scratch, key_type, tuple(hidden), narrow)
    names = iter(kept)
    whole = [derived[c].alias(c) if isinstance(c, str) and c in derived else next(names) for c in columns]
    return keyed.select(name, *whole, stamp(loaded_at).alias("_loaded_at"))


def fact_orders(
    stg_orders: DataFrame,
    dim_customers: DataFrame,
    dim_date: DataFrame,
    exchange_rates: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Orders with their value in US dollars; a currency without a rate counts as dollars."""
    # Tables of a fixed size first: what only they need is not shuffled to the others.
    rows = _customer(
        _rate(
            _day(with_row_tag(stg_orders), dim_date, F.col("order_date").cast("date"), "order_date_key"),
            exchange_rates,
        ),
        dim_customers,
    )
    # The fact's columns.
    columns = [
        "order_id",
        "customer_sk",
        "order_date_key",
        "order_status",
        "currency",
        "subtotal_amount",
        "discount_amount",
        "shipping_amount",
        "tax_amount",
        "total_amount",
        to_usd(F.col("total_amount"), F.col("_rate")).alias("total_amount_usd"),
        "payment_status",
        "is_cancelled",
        "is_paid",
        "has_total_mismatch",
        "updated_at",
    ]
    derived = {"is_cancelled": F.col("order_status") == "cancelled", "is_paid": F.col("payment_status") == "paid"}
    return _finish(rows, columns, ["order_id"], "order_sk", scratch, key_type, loaded_at, stg_orders, derived)


def fact_order_items(
    stg_order_items: DataFrame,
    fact_orders: DataFrame,
    dim_products: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Order lines with product cost; order currency and product cost are not converted."""
    rows = lookup(
        lookup_number(with_row_tag(stg_order_items), fact_orders, "order_id", "order_sk"),
        dim_products,
        "product_id",
        "product_id",
        {"product_sk": "product_sk", "unit_cost": "unit_cost"},
    )
    profit = F.col("line_total") - money(F.col("unit_cost") * F.col("quantity"))
    # The fact's columns.
    columns = [
        "order_item_id",
        "order_sk",
        "product_sk",
        "quantity",
        "unit_price",
        "discount_amount",
        "line_total",
        "unit_cost",
        "gross_profit",
        "has_line_total_mismatch",
    ]
    derived = {"gross_profit": profit.cast("decimal(19,2)")}
    return _finish(rows, columns, ["order_item_id"], "order_item_sk", scratch, key_type, loaded_at, stg_order_items, derived)


def fact_payments(
    stg_payments: DataFrame,
    fact_orders: DataFrame,
    dim_customers: DataFrame,
    dim_date: DataFrame,
    exchange_rates: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    rows = _rate(
        _day(with_row_tag(stg_payments), dim_date, F.col("provider_created_at").cast("date"), "payment_date_key"),
        exchange_rates,
    )
    rows = _customer(lookup_number(rows, fact_orders, "order_id", "order_sk"), dim_customers)
    # The fact's columns.
    columns = [
        "transaction_id",
        "order_sk",
        "customer_sk",
        "payment_date_key",
        "payment_method",
        "transaction_type",
        "status",
        "currency",
        "gross_amount",
        "fee_amount",
        "net_amount",
        to_usd(F.col("gross_amount"), F.col("_rate")).alias("gross_amount_usd"),
        "card_brand",
        "card_country",
        "failure_reason",
        F.col("refund_flag").alias("is_refund"),
        "is_successful",
    ]
    derived = {"is_successful": F.col("status") == "succeeded"}
    return _finish(rows, columns, ["transaction_id"], "payment_sk", scratch, key_type, loaded_at, stg_payments, derived)


def fact_inventory_daily(
    stg_inventory: DataFrame,
    dim_products: DataFrame,
    dim_date: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Stock per product, warehouse and day, with its value at the snapshot's unit cost."""
    rows = lookup(
        _day(with_row_tag(stg_inventory), dim_date, F.col("snapshot_date"), "snapshot_date_key"),
        dim_products,
        "product_id",
        "product_id",
        {"product_sk": "product_sk"},
    )
    # The fact's columns.
    columns = [
        "snapshot_date_key",
        "product_sk",
        "warehouse_id",
        "on_hand_qty",
        "reserved_qty",
        "available_qty",
        "reorder_point",
        "is_below_reorder",
        money(F.col("on_hand_qty") * F.col("unit_cost")).alias("inventory_value"),
    ]
    derived = {"is_below_reorder": F.col("available_qty") < F.col("reorder_point")}
    order = ["snapshot_date", "warehouse_id", "sku"]
    return _finish(rows, columns, order, "inventory_sk", scratch, key_type, loaded_at, stg_inventory, derived)


def fact_campaign_performance(
    stg_campaigns: DataFrame,
    dim_date: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Paid campaign days with click, cost and return ratios; NULL where the divisor is 0."""
    rows = _day(with_row_tag(stg_campaigns), dim_date, F.col("campaign_date"), "campaign_date_key")

    def per(numerator: str, denominator: str, digits: int) -> Column:
        return ratio(F.col(numerator), F.col(denominator), digits)

    # The fact's columns.
    columns = [
        "campaign_date_key",
        "platform",
        "campaign_id",
        "campaign_name",
        "channel",
        "country_code",
        "device_type",
        "impressions",
        "clicks",
        "spend",
        "conversions",
        "reported_revenue",
        "ctr",
        "cpc",
        "cpa",
        "roas",
    ]
    derived = {
        "ctr": per("clicks", "impressions", 4),
        "cpc": per("spend", "clicks", 2),
        "cpa": per("spend", "conversions", 2),
        "roas": per("reported_revenue", "spend", 2),
    }
    order = ["campaign_date", "campaign_id", "platform", "country_code", "device_type"]
    return _finish(rows, columns, order, "campaign_perf_sk", scratch, key_type, loaded_at, stg_campaigns, derived)


def fact_email_engagement(
    stg_sends: DataFrame,
    dim_customers: DataFrame,
    dim_date: DataFrame,
    scratch: Scratch,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    rows = _customer(
        _day(with_row_tag(stg_sends), dim_date, F.col("send_date"), "send_date_key"), dim_customers
    )
    # The fact's columns.
    columns = [
        "send_date_key",
        "campaign_id",
        "campaign_name",
        "customer_sk",
        "delivery_status",
        "is_delivered",
        F.col("open_flag").alias("is_opened"),
        F.col("click_flag").alias("is_clicked"),
        F.col("unsubscribe_flag").alias("is_unsubscribed"),
    ]
    derived = {"is_delivered": F.col("delivery_status") == "delivered"}
    order = ["send_date", "campaign_id", "customer_id"]
    return _finish(rows, columns, order, "email_sk", scratch, key_type, loaded_at, stg_sends, derived)


def fact_purchase_orders(
    stg_purchase_orders: DataFrame,
    dim_products: DataFrame,
    dim_date: DataFrame,
    scratch: Scratch,
    as_of: date,
    key_type: str = "int",
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Purchase orders joined to products by sku; a repeated sku repeats the order.

    An order expected before ``as_of`` and not yet received is overdue.
    """
    rows = lookup(
        _day(with_row_tag(stg_purchase_orders), dim_date, F.col("created_at").cast("date"), "created_date_key"),
        dim_products,
        "sku",
        "sku",
        {"product_sk": "product_sk"},
    )
    late = F.col("expected_delivery_date") < F.lit(as_of)
    # The fact's columns.
    columns = [
        "po_id",
        "supplier_id",
        "product_sk",
        "created_date_key",
        "expected_delivery_date",
        "ordered_qty",
        "received_qty",
        "unit_cost",
        "po_total",
        "po_status",
        "fill_rate",
        "is_overdue",
    ]
    derived = {
        "po_total": money(F.col("ordered_qty") * F.col("unit_cost")),
        "fill_rate": ratio(F.col("received_qty"), F.col("ordered_qty"), 2),
        "is_overdue": late & (F.col("po_status") != "received"),
    }
    return _finish(rows, columns, ["po_id"], "po_sk", scratch, key_type, loaded_at, stg_purchase_orders, derived)
