"""Business metrics over the star schema.

Facts are grouped as few times as the result allows, on the key of the result.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import ratio, round_half_away
from cartwright.functions.money import MONEY_SUM
from cartwright.operators import lookup, window_credit
from cartwright.plans.dims import stamp


def _zero() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def _total(value: Column) -> Column:
    return F.sum(value).cast(MONEY_SUM)


def with_day(fact: DataFrame, dim_date: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of a dated fact with the calendar day of ``key``; undated rows are dropped."""
    days = dim_date.select(F.col("date_key").alias("_key"), F.col("full_date").alias(name))
    return fact.join(F.broadcast(days), F.col(key) == F.col("_key")).drop("_key")


def customer_lifetime_value(
    dim_customers: DataFrame,
    fact_orders: DataFrame,
    dim_date: DataFrame,
    as_of: date,
    computed_at: datetime | None = None,
) -> DataFrame:
    """Order history and expected 90-day value per canonical customer.

    Cancelled orders count in ``total_orders`` and in the first and last order dates only.
    """
    people = dim_customers.groupBy("canonical_customer_id").agg(
        *[F.min(c).alias(c) for c in ("first_name", "last_name", "email", "country_code")]
    )
    members = dim_customers.select(F.col("customer_sk").alias("_sk"), "canonical_customer_id")
    kept = ~F.col("is_cancelled")
    dated = lookup(
        fact_orders.where(F.col("customer_sk").isNotNull()),
        dim_date,
        "order_date_key",
        "date_key",
        {"full_date": "_day"},
        fixed_size=True,
    )
    # The canonical id comes first, so orders are shuffled once: per order of a person, which
    # replaces two distinct counts over all rows, then per person.
    per_person = (
        dated.join(members, F.col("customer_sk") == F.col("_sk"))
        .groupBy("canonical_customer_id", "order_id")
        .agg(
            F.max(kept).alias("_kept"),
            F.sum(F.when(kept, F.col("total_amount_usd")).otherwise(_zero())).alias("_revenue"),
            F.sum(F.when(kept, F.col("discount_amount")).otherwise(_zero())).alias("_discount"),
            F.min("_day").alias("_first"),
            F.max("_day").alias("_last"),
        )
        .groupBy("canonical_customer_id")
        .agg(
            F.count("order_id").alias("_orders"),
            F.count_if(F.col("_kept") & F.col("order_id").isNotNull()).alias("_completed"),
            _total(F.col("_revenue")).alias("_revenue"),
            _total(F.col("_discount")).alias("_discount"),
            F.min("_first").alias("first_order_date"),
            F.max("_last").alias("last_order_date"),
        )
    )
    joined = people.join(per_person, "canonical_customer_id", "left")
    revenue = F.coalesce("_revenue", _zero()).cast(MONEY_SUM)
    discount = F.coalesce("_discount", _zero()).cast(MONEY_SUM)
    completed = F.coalesce("_completed", F.lit(0)).cast("bigint")
    first, last = F.col("first_order_date"), F.col("last_order_date")
    tenure = F.datediff(last, first).cast("bigint")
    average = ratio(revenue, completed)
    per_day = ratio(completed, F.greatest(tenure, F.lit(1)))
    return joined.select(
        "canonical_customer_id",
        "first_name",
        "last_name",
        "email",
        "country_code",
        F.coalesce("_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        completed.alias("completed_orders"),
        revenue.alias("lifetime_revenue_usd"),
        round_half_away(average, 2).alias("avg_order_value_usd"),
        discount.alias("lifetime_discount"),
        first,
        last,
        F.coalesce(tenure, F.lit(0)).cast("bigint").alias("customer_tenure_days"),
        F.datediff(F.lit(as_of), last).cast("bigint").alias("days_since_last_order"),
        round_half_away(average * (per_day * 90), 2).alias("estimated_clv_90d"),
        stamp(computed_at).alias("_computed_at"),
    )


def order_conversion_rate(
    fact_orders: DataFrame, dim_date: DataFrame, computed_at: datetime | None = None
) -> DataFrame:
    """Orders, revenue and rates per order day, in day order. Undated orders are left out."""
    paid, cancelled = F.col("is_paid"), F.col("is_cancelled")
    usd = F.col("total_amount_usd")
    per_key = fact_orders.groupBy("order_date_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(~cancelled).alias("non_cancelled_orders"),
        F.count_if(paid).alias("paid_orders"),
        F.count_if(cancelled).alias("cancelled_orders"),
        _total(usd).alias("total_gmv_usd"),
        _total(F.when(paid, usd).otherwise(_zero())).alias("paid_revenue_usd"),
    )
    dated = with_day(per_key, dim_date, "order_date_key", "order_date")
    total = F.col("total_orders")
    return dated.select(
        "order_date",
        "total_orders",
        "non_cancelled_orders",
        "paid_orders",
        "cancelled_orders",
        "total_gmv_usd",
        "paid_revenue_usd",
        ratio(F.col("non_cancelled_orders"), total, 4).alias("non_cancel_rate"),
        ratio(F.col("paid_orders"), total, 4).alias("payment_conversion_rate"),
        ratio(F.col("cancelled_orders"), total, 4).alias("cancellation_rate"),
        stamp(computed_at).alias("_computed_at"),
    ).orderBy(F.col("order_date").asc_nulls_last())


def attributed_revenue(
    fact_email: DataFrame, fact_orders: DataFrame, dim_date: DataFrame, days: int = 7
) -> DataFrame:
    """Revenue of orders placed by a customer within ``days`` of a send, per campaign.

    There is no last touch: an order counts for every campaign that reached the customer,
    once per send, also when the send bounced. Cancelled orders are left out.
    """
    sends = with_day(
        fact_email.select("campaign_id", "customer_sk", "send_date_key"),
        dim_date,
        "send_date_key",
        "send_day",
    )
    orders = with_day(
        fact_orders.where(~F.col("is_cancelled")).select(
            "order_id", "customer_sk", "order_date_key", "total_amount_usd"
        ),
        dim_date,
        "order_date_key",
        "order_day",
    )
    credit = window_credit(
        sends,
        orders,
        campaign="campaign_id",
        person="customer_sk",
        touch_day="send_day",
        outcome_id="order_id",
        outcome_day="order_day",
        amount="total_amount_usd",
        days=days,
    )
    return credit.select(
        F.col("campaign").alias("campaign_id"),
        F.col("amount").cast(MONEY_SUM).alias("attributed_revenue_usd"),
        F.col("outcomes").cast("bigint").alias("attributed_orders"),
    )


def revenue_by_campaign(
    fact_email: DataFrame,
    fact_campaigns: DataFrame,
    fact_orders: DataFrame,
    dim_date: DataFrame,
    computed_at: datetime | None = None,
) -> DataFrame:
    """E-mail reach, paid spend and attributed revenue side by side, per campaign."""
    reach = fact_email.groupBy("campaign_id").agg(
        F.min("campaign_name").alias("_reach_name"),
        F.count(F.lit(1)).alias("total_sends"),
        F.count_if("is_delivered").alias("delivered"),
        F.count_if("is_opened").alias("opened"),
        F.count_if("is_clicked").alias("clicked"),
    )
    spend = fact_campaigns.groupBy(F.col("campaign_id").alias("_paid_id")).agg(
        F.min("campaign_name").alias("_paid_name"),
        _total(F.col("spend")).alias("total_spend"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("paid_clicks"),
        F.sum("conversions").alias("total_conversions"),
        _total(F.col("reported_revenue")).alias("paid_reported_revenue"),
    )
    both = reach.join(spend, F.col("campaign_id") == F.col("_paid_id"), "full").withColumn(
        "campaign_id", F.coalesce("campaign_id", "_paid_id")
    )
    credit = attributed_revenue(fact_email, fact_orders, dim_date)
    revenue = F.coalesce("attributed_revenue_usd", _zero()).cast(MONEY_SUM)
    return both.join(credit, "campaign_id", "left").select(
        "campaign_id",
        F.coalesce("_reach_name", "_paid_name").alias("campaign_name"),
        "total_sends",
        "delivered",
        "opened",
        "clicked",
        "total_spend",
        "total_impressions",
        "paid_clicks",
        "total_conversions",
        "paid_reported_revenue",
        F.coalesce("attributed_orders", F.lit(0)).cast("bigint").alias("attributed_orders"),
        revenue.alias("attributed_revenue_usd"),
        ratio(revenue, F.col("total_spend"), 2).alias("attributed_roas"),
        stamp(computed_at).alias("_computed_at"),
    )


def inventory_turnover(
    fact_order_items: DataFrame,
    fact_orders: DataFrame,
    dim_products: DataFrame,
    fact_inventory: DataFrame,
    fact_purchase_orders: DataFrame,
    computed_at: datetime | None = None,
) -> DataFrame:
    """Sales against stock and open supply, per product with at least one kept sale."""
    kept = fact_orders.where(~F.col("is_cancelled")).select("order_sk")
    sales = (
        fact_order_items.join(kept, "order_sk")
        .groupBy("product_sk")
        .agg(
            F.sum("quantity").alias("units_sold"),
            _total(F.col("line_total")).alias("total_sales_revenue"),
            _total(F.col("gross_profit")).alias("total_gross_profit"),
        )
    )
    stock = fact_inventory.groupBy("product_sk").agg(
        F.sum("on_hand_qty").alias("total_on_hand"),
        F.sum("available_qty").alias("total_available"),
        F.sum("reserved_qty").alias("total_reserved"),
        F.max("is_below_reorder").alias("any_below_reorder"),
        _total(F.col("inventory_value")).alias("total_inventory_value"),
    )
    supply = (
        fact_purchase_orders.where(F.col("po_status") != "received")
        .groupBy("product_sk")
        .agg(
            F.sum(F.col("ordered_qty") - F.col("received_qty")).alias("_incoming"),
            F.count(F.lit(1)).alias("_open"),
        )
    )
    products = dim_products.select(
        "product_sk", "product_id", "sku", "product_name", "category_standardized", "unit_cost"
    )
    joined = (
        sales.join(products, "product_sk")
        .join(stock, "product_sk", "left")
        .join(supply, "product_sk", "left")
    )
    sold_cost = F.col("units_sold").cast("decimal(19,0)") * F.col("unit_cost")
    return joined.select(
        "product_sk",
        "product_id",
        "sku",
        "product_name",
        "category_standardized",
        "units_sold",
        "total_sales_revenue",
        "total_gross_profit",
        "total_on_hand",
        "total_available",
        "total_reserved",
        "any_below_reorder",
        "total_inventory_value",
        ratio(sold_cost, F.col("total_inventory_value"), 4).alias("inventory_turnover_ratio"),
        ratio(F.col("total_on_hand"), F.col("units_sold"), 1).alias("days_of_supply"),
        F.coalesce("_incoming", F.lit(0)).cast("bigint").alias("incoming_supply_qty"),
        F.coalesce("_open", F.lit(0)).cast("bigint").alias("open_po_count"),
        stamp(computed_at).alias("_computed_at"),
    )
