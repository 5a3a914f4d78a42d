"""Shop entities derived from TPC-H-like tables.

Each role is one SELECT that Spark and DuckDB both read, so that a comparison tests the
models and not the derivation. ``{name}`` is an input table, ``<timestamp>`` the type of a
wall-clock timestamp. Derived data keeps faults on purpose: repeated ids, missing e-mails,
an unknown currency, totals and payments that do not add up.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cartwright.plans.publish import CODEC
from cartwright.plans.warehouse import Warehouse
from cartwright.quality.specs import UNIQUE
from cartwright.sources.scratch import Scratch

AS_OF = date(1998, 9, 2)
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2027, 12, 31)
ID_TYPE = "bigint"

_CENTS = "CAST(ROUND(l_extendedprice * 100) AS BIGINT)"
_UNIT_PRICE = (
    f"CAST(CAST(FLOOR({_CENTS} / CAST(l_quantity AS INT)) AS BIGINT) * 0.01 AS DECIMAL(18,2))"
)

ROLES = {
    # Two versions of every customer; the older one of every third is equally new.
    "customers": """
        WITH versions AS (
            SELECT *, 0 AS version FROM {customer}
            UNION ALL
            SELECT *, 1 AS version FROM {customer}
        )
        SELECT c_custkey AS customer_id,
            CASE WHEN c_custkey % 11 = 3 THEN NULL
                 ELSE '  User' || CAST(c_custkey % 1000 AS STRING) || '@Example.COM ' END AS email,
            ' First' || CAST(c_custkey % 7 AS STRING) AS first_name,
            c_name || ' ' AS last_name,
            CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS STRING) || '.0' END AS phone,
            CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INT)
                 - CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 30 * version END AS <timestamp>)
                AS created_at,
            ' ' || LOWER(n_name) AS country_code,
            CASE WHEN version = 0 THEN c_mktsegment ELSE 'Older' END AS status,
            c_custkey % 2 = 0 AS marketing_opt_in
        FROM versions JOIN {nation} ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey AS product_id,
            ' SKU-' || CAST(p_partkey AS STRING) AS sku,
            p_name AS product_name,
            CASE p_type WHEN 'ECONOMY' THEN ' Shoes ' WHEN 'SMALL' THEN 'Accessories'
                WHEN 'MEDIUM' THEN 'bags / urban' WHEN 'LARGE' THEN 'ELECTRONICS'
                WHEN 'STANDARD' THEN 'apparel' ELSE p_type END AS category,
            p_brand || ' ' AS brand,
            CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.6, 2) AS DECIMAL(18,2))
                AS unit_cost,
            CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
            p_size % 10 <> 0 AS is_active,
            CAST(DATE '1994-01-01' + p_size AS <timestamp>) AS created_at
        FROM {part}""",
    # Store orders and web purchases; totals are off by 2 cents or 1 cent now and then.
    "orders": """
        WITH placed AS (
            SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                CAST(o_orderdate AS <timestamp>) AS order_date,
                CASE o_orderstatus WHEN 'F' THEN ' Completed' WHEN 'O' THEN 'pending'
                    ELSE 'CANCELLED' END AS order_status,
                CASE o_custkey % 3 WHEN 0 THEN 'usd' WHEN 1 THEN ' PHP' ELSE 'eur' END AS currency,
                CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
                CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PAID'
                    ELSE 'pending' END AS payment_status,
                CAST(CASE o_orderkey % 40 WHEN 7 THEN 0.02 WHEN 8 THEN 0.01 ELSE 0.00 END
                    AS DECIMAL(18,2)) AS gap
            FROM {orders}
            UNION ALL
            SELECT -1 - event_id, user_id, CAST(ts AS <timestamp>),
                CASE WHEN event_id % 10 = 0 THEN 'cancelled' ELSE 'completed' END,
                CASE WHEN event_id % 2 = 0 THEN 'USD' ELSE 'PHP' END,
                CAST(value AS DECIMAL(18,2)), 'paid', CAST(0.00 AS DECIMAL(18,2))
            FROM {events} WHERE event_type = 'purchase'
        )
        SELECT order_id, customer_id, order_date, order_status, currency,
            CAST(total_amount - 2.50 + gap AS DECIMAL(18,2)) AS subtotal_amount,
            CAST(order_id % 5 + 4 AS DECIMAL(18,2)) AS discount_amount,
            CAST(order_id % 5 + 5 AS DECIMAL(18,2)) AS shipping_amount,
            CAST(1.50 AS DECIMAL(18,2)) AS tax_amount,
            total_amount, payment_status,
            customer_id AS shipping_address_id, customer_id + 1 AS billing_address_id,
            order_date AS updated_at
        FROM placed""",
    "order_items": f"""
        SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id,
            l_partkey AS product_id, 'SKU-' || CAST(l_partkey AS STRING) || ' ' AS sku,
            ' Part ' || CAST(l_partkey AS STRING) AS product_name,
            CAST(l_quantity AS INT) AS quantity, {_UNIT_PRICE} AS unit_price,
            CAST(0.00 AS DECIMAL(18,2)) AS discount_amount,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total
        FROM {{lineitem}}""",
    "payment_transactions": """
        WITH paid AS (
            SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS gross_amount,
                CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * 0.029, 2) AS DECIMAL(18,2))
                    AS fee_amount
            FROM {orders}
        )
        SELECT ' txn_' || CAST(o_orderkey AS STRING) AS transaction_id, o_orderkey AS order_id,
            o_custkey AS customer_id,
            CASE WHEN o_orderkey % 4 = 0 THEN 'EWallet' ELSE 'Card ' END AS payment_method,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'Capture' WHEN '2-HIGH' THEN 'VOID'
                WHEN '3-MEDIUM' THEN 'authorization' ELSE 'refund' END AS transaction_type,
            CASE o_orderstatus WHEN 'F' THEN 'Succeeded' WHEN 'O' THEN 'pending'
                ELSE 'FAILED' END AS status,
            CASE WHEN o_orderkey % 50 = 0 THEN 'USD' WHEN o_custkey % 3 = 0 THEN 'usd'
                WHEN o_custkey % 3 = 1 THEN 'php' ELSE 'EUR' END AS currency,
            gross_amount, fee_amount,
            CAST(gross_amount - fee_amount
                 - CASE WHEN o_orderkey % 25 = 0 THEN 0.05 ELSE 0.00 END AS DECIMAL(18,2))
                AS net_amount,
            CAST(o_orderdate AS <timestamp>) AS provider_created_at,
            CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE ' Visa' END AS card_brand,
            CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'us ' END AS card_country,
            CASE WHEN o_orderstatus = 'P' THEN 'declined ' ELSE '  ' END AS failure_reason,
            o_orderkey % 9 = 0 AS refund_flag
        FROM paid""",
    "campaign_performance": """
        WITH touched AS (
            SELECT CAST(ts AS DATE) AS campaign_date, event_type,
                CAST(value AS DECIMAL(18,2)) AS amount,
                'C' || CAST(10 + event_id % 20 AS STRING) AS campaign_id,
                CASE event_id % 3 WHEN 0 THEN 'Meta' WHEN 1 THEN 'GOOGLE' ELSE 'tiktok' END
                    AS platform
            FROM {events}
        )
        SELECT campaign_date, platform, campaign_id, ' Paid ' || campaign_id AS campaign_name,
            'Paid_Social' AS channel, CAST(COUNT(*) * 100 AS INT) AS impressions,
            CAST(COUNT(CASE WHEN event_type = 'click' THEN 1 END) * 7 AS INT) AS clicks,
            CAST(SUM(amount) AS DECIMAL(18,2)) AS spend,
            CAST(COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS INT) AS conversions,
            CAST(SUM(CASE WHEN event_type = 'purchase' THEN amount ELSE 0 END) * 3
                 AS DECIMAL(18,2)) AS reported_revenue,
            'us' AS country_code, ' Mobile' AS device_type,
            'events' AS load_filename, CAST(campaign_date AS <timestamp>) AS loaded_at
        FROM touched GROUP BY campaign_date, platform, campaign_id""",
    "email_sends": """
        SELECT CAST(ts AS DATE) AS send_date, 'C' || CAST(event_id % 20 AS STRING) AS campaign_id,
            ' Mail ' || CAST(event_id % 20 AS STRING) AS campaign_name,
            ' USER' || CAST(user_id AS STRING) || '@example.com' AS recipient_email,
            user_id AS customer_id,
            CASE event_type WHEN 'view' THEN 'Delivered' WHEN 'click' THEN 'delivered '
                WHEN 'error' THEN 'BOUNCED' ELSE 'sent' END AS delivery_status,
            event_type IN ('view', 'click') AS open_flag, event_type = 'click' AS click_flag,
            event_type = 'error' AS unsubscribe_flag, 'events' AS load_filename,
            CAST(ts AS <timestamp>) AS loaded_at
        FROM {events}""",
    "inventory_snapshot": """
        WITH stock AS (
            SELECT l_partkey AS product_id, l_suppkey % 5 + 1 AS warehouse_id,
                SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS INT) ELSE 0 END)
                    AS on_hand_qty,
                SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) ELSE 0 END)
                    AS reserved_qty
            FROM {lineitem} GROUP BY l_partkey, l_suppkey % 5 + 1
        )
        SELECT DATE '1998-09-02' AS snapshot_date, warehouse_id,
            ' SKU-' || CAST(product_id AS STRING) AS sku, product_id,
            CAST(on_hand_qty AS BIGINT) AS on_hand_qty, CAST(reserved_qty AS BIGINT) AS reserved_qty,
            CAST(on_hand_qty - reserved_qty AS BIGINT) AS available_qty,
            product_id % 50 AS reorder_point,
            CAST(product_id % 100 + 10.25 AS DECIMAL(18,2)) AS unit_cost
        FROM stock""",
    "purchase_orders": f"""
        SELECT l_orderkey * 8 + l_linenumber AS po_id, l_suppkey AS supplier_id,
            ' SKU-' || CAST(l_partkey AS STRING) AS sku, CAST(l_quantity AS INT) AS ordered_qty,
            CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE FLOOR(l_quantity / 2) END
                 AS INT) AS received_qty,
            {_UNIT_PRICE} AS unit_cost,
            CASE WHEN l_linestatus = 'F' THEN 'Received' ELSE 'OPEN ' END AS po_status,
            CAST(l_shipdate AS <timestamp>) AS created_at,
            CAST(l_shipdate AS DATE) + 10 AS expected_delivery_date
        FROM {{lineitem}}""",
    # Histories.
    "tasks": """
        SELECT CAST(CAST(ts AS DATE) AS STRING) AS pipeline_run_id, 'daily' AS dag_id,
            event_type AS task_id,
            CASE WHEN event_type = 'error' AND value > 20 THEN 'failed' ELSE 'success' END
                AS status,
            CAST(ts AS <timestamp>) AS start_time, CAST(ts AS <timestamp>) AS end_time,
            CASE WHEN event_id % 13 = 0 THEN 'n/a'
                 ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS duration_seconds,
            CAST(event_id % 3 + 1 AS INT) AS attempts,
            REPEAT(props, CAST(event_id % 60 AS INT)) AS error
        FROM {events}""",
    "load_log": """
        SELECT CAST(CAST(ts AS DATE) AS STRING) AS run_id,
            CASE user_id % 4 WHEN 0 THEN 'postgres' WHEN 1 THEN 'payments'
                WHEN 2 THEN 'marketing' ELSE 'inventory' END AS source,
            CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
            event_id AS rows_ingested
        FROM {events}""",
    "load_requests": """
        SELECT event_id AS request_id,
            CASE event_id % 6 WHEN 0 THEN 'postgres' WHEN 1 THEN 'payments' WHEN 2 THEN 'marketing'
                WHEN 3 THEN 'inventory' WHEN 4 THEN 'postgres' ELSE 'ftp' END AS source,
            CASE event_id % 6 WHEN 0 THEN 'orders' WHEN 1 THEN 'transactions'
                WHEN 2 THEN 'email_sends' WHEN 3 THEN ' ' WHEN 4 THEN event_type
                ELSE 'orders' END AS entity,
            CASE event_id % 7 WHEN 0 THEN '2024-02-30' WHEN 1 THEN '2024/01/15' WHEN 2 THEN NULL
                ELSE CAST(CAST(ts AS DATE) AS STRING) END AS partition_date
        FROM {events}""",
    "check_reports": """
        SELECT CAST(CAST(ts AS DATE) AS STRING) AS run_id, 'large_' || event_type AS check_id,
            COUNT(CASE WHEN value > 150 THEN 1 END) AS failing_rows,
            COUNT(CASE WHEN value > 150 THEN 1 END) = 0 AS passed
        FROM {events} GROUP BY CAST(ts AS DATE), event_type""",
    # Texts of a table whose value column changes its type on some days.
    "event_texts": """
        SELECT CAST(CAST(ts AS DATE) AS STRING) AS dt, CAST(event_id AS STRING) AS event_id,
            CAST(ts AS STRING) AS ts,
            CASE WHEN event_id % 500 = 3 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id,
            event_type,
            CASE WHEN DAY(ts) % 10 = 0 THEN 'EUR ' || CAST(value AS STRING)
                 ELSE CAST(value AS STRING) END AS value,
            props
        FROM {events}""",
}

# Amounts whose sign is turned on every seventh row, by table: the key and the columns.
TURNED_AMOUNTS = {
    "fact_orders": ("order_sk", ("total_amount", "total_amount_usd")),
    "fact_order_items": ("order_item_sk", ("unit_price", "gross_profit")),
    "fact_payments": ("payment_sk", ("gross_amount",)),
    "fact_inventory_daily": ("inventory_sk", ("inventory_value",)),
    "fact_purchase_orders": ("po_sk", ("po_total",)),
}
# Parents that lack some keys: what is kept of them.
KEPT_PARENTS = {
    "dim_customers": "customer_sk % 10 <> 0",
    "dim_products": "product_sk % 10 <> 0",
    "dim_date": "date_key % 10 <> 0",
    "fact_orders": "order_sk % 10 <> 0",
}


def turned(table: str, column: str) -> str:
    key = TURNED_AMOUNTS[table][0]
    return f"CASE WHEN {key} % 7 = 0 THEN -{column} ELSE {column} END"


#: Columns of the orders that get another type, for the schema checks.
RETYPED = {"total_amount": "double", "order_date_key": "bigint"}


def repeats(name: str) -> tuple[str, str]:
    """A checked table's key, and the number that says which of its rows are repeated or lose it."""
    key = UNIQUE[name][0]
    numbers = {"gold.fact_payments": "payment_sk", "silver.stg_payment_transactions": "order_id"}
    return key, numbers.get(name, key)


INPUTS = ("nation", "customer", "part", "orders", "lineitem", "events")


def role_sql(name: str) -> str:
    """The role for DuckDB, where input tables are views of the same name."""
    return ROLES[name].replace("<timestamp>", "TIMESTAMP").format(**{t: t for t in INPUTS})


def role(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = ROLES[name].replace("<timestamp>", "TIMESTAMP_NTZ")
    frames = {
        t: spark.read.parquet(f"{folder}/{t}.parquet") for t in INPUTS if "{" + t + "}" in text
    }
    return spark.sql(text, **frames)


class _Roles(dict):
    """Roles by bronze table name, read when first asked for.

    Grouped roles are stored first: bronze tables are stored tables or row-wise views of them.
    """

    def __init__(self, spark: SparkSession, folder: str, scratch: Scratch):
        super().__init__()
        self._spark, self._folder, self._scratch = spark, folder, scratch

    def __contains__(self, name: object) -> bool:
        return name in ROLES

    def __missing__(self, name: str) -> DataFrame:
        table = role(self._spark, self._folder, name)
        if "GROUP BY" in ROLES[name]:
            table = self._scratch.stage(table, name)
        self[name] = table
        return table


def shop(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over the roles."""
    scratch = Scratch(spark, codec=CODEC)
    return Warehouse(
        spark,
        _Roles(spark, folder, scratch),
        AS_OF,
        first_day=FIRST_DAY,
        last_day=LAST_DAY,
        id_type=ID_TYPE,
        scratch=scratch,
    )
