"""The registered queries in SQL for DuckDB.

Tables are built up as named steps; a query lists the steps it starts from and the rest is
added by dependency. Every step is written from the definition of its result, with global
windows and plain joins, and shares no text with the Spark models.
"""

from __future__ import annotations

import re

from cartwright.plans.warehouse import GOLD, LAYERS
from cartwright.quality import specs
from cartwright.registry.queries import MODELS
from cartwright.registry.roles import (
    AS_OF,
    FIRST_DAY,
    KEPT_PARENTS,
    LAST_DAY,
    RETYPED,
    ROLES,
    TURNED_AMOUNTS,
    repeats,
    role_sql,
    turned,
)
from cartwright.sources.entities import ENTITIES
from cartwright.sources.seeds import CATEGORY_MAP, EXCHANGE_RATES

MONEY, WIDE = "DECIMAL(18,2)", "DECIMAL(38,2)"


def _off_by_cents(a: str, b: str) -> str:
    return f"abs({a} - ({b})) > 0.01::{MONEY}"


_STOCK = "on_hand_qty reserved_qty available_qty reorder_point"

STEPS: dict[str, str] = {f"b_{name}": role_sql(name) for name in ROLES}
STEPS |= {
    "category": "SELECT * FROM (VALUES "
    + ", ".join(f"('{k}', '{v}')" for k, v in CATEGORY_MAP.items())
    + ") t(raw, nice)",
    "fx": "SELECT * FROM (VALUES "
    + ", ".join(f"('{k}', {v}::DECIMAL(5,4))" for k, v in EXCHANGE_RATES.items())
    + ") t(code, rate)",
    "stg_customers": """
        SELECT customer_id, lower(trim(email)) AS email, trim(first_name) AS first_name,
            trim(last_name) AS last_name,
            nullif(trim(regexp_replace(phone, '[.]0$', '')), '') AS phone, created_at,
            upper(trim(country_code)) AS country_code, lower(trim(status)) AS status,
            marketing_opt_in,
            count(*) OVER (PARTITION BY lower(trim(email))) > 1 AS is_duplicate_email
        FROM (
            SELECT * FROM b_customers
            QUALIFY row_number() OVER (
                PARTITION BY customer_id
                ORDER BY created_at DESC NULLS LAST, email, first_name, last_name, phone,
                    country_code, status, marketing_opt_in) = 1
        )""",
    "stg_products": f"""
        SELECT product_id, trim(sku) AS sku, trim(product_name) AS product_name,
            lower(trim(category)) AS category_raw,
            coalesce(nice, 'Uncategorized') AS category_standardized, trim(brand) AS brand,
            unit_cost::{MONEY} AS unit_cost, list_price::{MONEY} AS list_price,
            round((list_price::DOUBLE - unit_cost::DOUBLE) / nullif(list_price::DOUBLE, 0) * 100, 2)
                AS gross_margin_pct,
            is_active, created_at
        FROM b_products LEFT JOIN category ON raw = lower(trim(category))""",
    "stg_orders": f"""
        SELECT * REPLACE (lower(trim(order_status)) AS order_status,
                upper(trim(currency)) AS currency, lower(trim(payment_status)) AS payment_status),
            {_off_by_cents("total_amount",
                           "subtotal_amount - discount_amount + shipping_amount + tax_amount")}
                AS has_total_mismatch
        FROM b_orders""",
    "stg_order_items": f"""
        SELECT * REPLACE (trim(sku) AS sku, trim(product_name) AS product_name),
            {_off_by_cents("line_total", "unit_price * quantity - discount_amount")}
                AS has_line_total_mismatch
        FROM b_order_items""",
    "stg_payment_transactions": """
        SELECT * REPLACE (trim(transaction_id) AS transaction_id,
                lower(trim(payment_method)) AS payment_method,
                lower(trim(transaction_type)) AS transaction_type, lower(trim(status)) AS status,
                upper(trim(currency)) AS currency, lower(nullif(trim(card_brand), '')) AS card_brand,
                upper(nullif(trim(card_country), '')) AS card_country,
                nullif(trim(failure_reason), '') AS failure_reason)
        FROM b_payment_transactions""",
    "stg_campaign_performance": """
        SELECT * REPLACE (lower(trim(platform)) AS platform, trim(campaign_id) AS campaign_id,
                trim(campaign_name) AS campaign_name, lower(trim(channel)) AS channel,
                upper(trim(country_code)) AS country_code,
                lower(trim(device_type)) AS device_type, trim(load_filename) AS load_filename)
        FROM b_campaign_performance""",
    "stg_email_sends": """
        SELECT * REPLACE (trim(campaign_id) AS campaign_id, trim(campaign_name) AS campaign_name,
                lower(trim(recipient_email)) AS recipient_email,
                lower(trim(delivery_status)) AS delivery_status,
                trim(load_filename) AS load_filename)
        FROM b_email_sends""",
    "stg_inventory_snapshot": "SELECT * REPLACE (trim(sku) AS sku, warehouse_id::INT AS warehouse_id, "
    + ", ".join(f"{c}::INT AS {c}" for c in _STOCK.split())
    + ") FROM b_inventory_snapshot",
    "stg_purchase_orders": """
        SELECT * REPLACE (trim(sku) AS sku, lower(trim(po_status)) AS po_status)
        FROM b_purchase_orders""",
    "calendar": f"""
        SELECT d::DATE AS full_date, strftime(d, '%Y%m%d')::INT AS date_key
        FROM range(DATE '{FIRST_DAY}', DATE '{LAST_DAY}' + 1, INTERVAL 1 DAY) t(d)""",
    "dim_customers": """
        SELECT row_number() OVER (ORDER BY canonical_customer_id, customer_id) AS customer_sk, *
        FROM (
            SELECT customer_id, min(customer_id) OVER (PARTITION BY email) AS canonical_customer_id,
                email, first_name, last_name, phone, country_code, status, marketing_opt_in,
                created_at, is_duplicate_email, true AS is_current, created_at AS valid_from,
                NULL::TIMESTAMP AS valid_to
            FROM stg_customers WHERE email IS NOT NULL
        )""",
    "dim_products": "SELECT row_number() OVER (ORDER BY product_id) AS product_sk, * FROM stg_products",
    "fact_orders": f"""
        SELECT row_number() OVER (ORDER BY order_id) AS order_sk, order_id, customer_sk,
            date_key AS order_date_key, order_status, currency, subtotal_amount, discount_amount,
            shipping_amount, tax_amount, total_amount,
            round(total_amount * CASE WHEN rate IS NULL THEN 1 ELSE rate END, 2)::{MONEY}
                AS total_amount_usd,
            payment_status, order_status = 'cancelled' AS is_cancelled,
            payment_status = 'paid' AS is_paid, has_total_mismatch, updated_at
        FROM stg_orders
        LEFT JOIN (SELECT customer_id, customer_sk FROM dim_customers) USING (customer_id)
        LEFT JOIN calendar ON full_date = order_date::DATE
        LEFT JOIN fx ON code = currency""",
    "items_joined": f"""
        SELECT order_item_id, order_sk, product_sk, quantity, unit_price, discount_amount,
            line_total, unit_cost,
            round(line_total - unit_cost * quantity, 2)::DECIMAL(19,2) AS gross_profit,
            has_line_total_mismatch
        FROM stg_order_items
        LEFT JOIN (SELECT order_id, order_sk FROM fact_orders) USING (order_id)
        LEFT JOIN (SELECT product_id, product_sk, unit_cost FROM dim_products) USING (product_id)""",
    "fact_order_items": """
        SELECT row_number() OVER (ORDER BY order_item_id, order_sk, product_sk, quantity, unit_price,
                discount_amount, line_total, unit_cost, gross_profit, has_line_total_mismatch)
                AS order_item_sk, * FROM items_joined""",
    "fact_payments": f"""
        SELECT row_number() OVER (ORDER BY transaction_id) AS payment_sk, transaction_id, order_sk,
            customer_sk, date_key AS payment_date_key, payment_method, transaction_type, status,
            currency, gross_amount, fee_amount, net_amount,
            round(gross_amount * CASE WHEN rate IS NULL THEN 1 ELSE rate END, 2)::{MONEY}
                AS gross_amount_usd,
            card_brand, card_country, failure_reason, refund_flag AS is_refund,
            status = 'succeeded' AS is_successful
        FROM stg_payment_transactions
        LEFT JOIN (SELECT order_id, order_sk FROM fact_orders) USING (order_id)
        LEFT JOIN (SELECT customer_id, customer_sk FROM dim_customers) USING (customer_id)
        LEFT JOIN calendar ON full_date = provider_created_at::DATE
        LEFT JOIN fx ON code = currency""",
    "fact_inventory_daily": f"""
        SELECT row_number() OVER (ORDER BY snapshot_date, warehouse_id, s.sku) AS inventory_sk,
            date_key AS snapshot_date_key, product_sk, warehouse_id, on_hand_qty, reserved_qty,
            available_qty, reorder_point, available_qty < reorder_point AS is_below_reorder,
            (on_hand_qty * s.unit_cost)::{MONEY} AS inventory_value
        FROM stg_inventory_snapshot s LEFT JOIN dim_products USING (product_id)
        LEFT JOIN calendar ON full_date = snapshot_date""",
    "fact_campaign_performance": """
        SELECT row_number() OVER (ORDER BY campaign_date, campaign_id, platform) AS campaign_perf_sk,
            date_key AS campaign_date_key, platform, campaign_id, campaign_name, channel,
            country_code, device_type, impressions, clicks, spend, conversions, reported_revenue,
            round(clicks::DOUBLE / nullif(impressions, 0), 4) AS ctr,
            round(spend::DOUBLE / nullif(clicks, 0), 2) AS cpc,
            round(spend::DOUBLE / nullif(conversions, 0), 2) AS cpa,
            round(reported_revenue::DOUBLE / nullif(spend, 0)::DOUBLE, 2) AS roas
        FROM stg_campaign_performance LEFT JOIN calendar ON full_date = campaign_date""",
    "sends_joined": """
        SELECT send_date, customer_id, date_key AS send_date_key, campaign_id, campaign_name,
            customer_sk, delivery_status, delivery_status = 'delivered' AS is_delivered,
            open_flag AS is_opened, click_flag AS is_clicked, unsubscribe_flag AS is_unsubscribed
        FROM stg_email_sends
        LEFT JOIN (SELECT customer_id, customer_sk FROM dim_customers) USING (customer_id)
        LEFT JOIN calendar ON full_date = send_date""",
    "fact_email_engagement": """
        SELECT row_number() OVER (ORDER BY send_date, campaign_id, customer_id, send_date_key,
                campaign_name, customer_sk, delivery_status, is_delivered, is_opened, is_clicked,
                is_unsubscribed) AS email_sk, * EXCLUDE (send_date, customer_id)
        FROM sends_joined""",
    "po_joined": f"""
        SELECT po_id, supplier_id, product_sk, date_key AS created_date_key,
            expected_delivery_date, ordered_qty, received_qty, p.unit_cost,
            (ordered_qty * p.unit_cost)::{MONEY} AS po_total, po_status,
            round(received_qty::DOUBLE / nullif(ordered_qty, 0), 2) AS fill_rate,
            expected_delivery_date < DATE '{AS_OF}' AND po_status <> 'received' AS is_overdue
        FROM stg_purchase_orders p LEFT JOIN (SELECT sku, product_sk FROM dim_products) USING (sku)
        LEFT JOIN calendar ON full_date = p.created_at::DATE""",
    "fact_purchase_orders": """
        SELECT row_number() OVER (ORDER BY po_id, supplier_id, product_sk, created_date_key,
                expected_delivery_date, ordered_qty, received_qty, unit_cost, po_total, po_status,
                fill_rate, is_overdue) AS po_sk, * FROM po_joined""",
    "metric_customer_lifetime_value": f"""
        WITH history AS (
            SELECT c.canonical_customer_id, min(first_name) AS first_name,
                min(last_name) AS last_name, min(email) AS email,
                min(country_code) AS country_code,
                count(DISTINCT order_id) AS total_orders,
                count(DISTINCT order_id) FILTER (NOT is_cancelled) AS completed_orders,
                coalesce(sum(total_amount_usd) FILTER (NOT is_cancelled), 0)::{WIDE} AS revenue,
                coalesce(sum(discount_amount) FILTER (NOT is_cancelled), 0)::{WIDE} AS discount,
                min(full_date) AS first_order_date, max(full_date) AS last_order_date
            FROM dim_customers c LEFT JOIN fact_orders o ON o.customer_sk = c.customer_sk
            LEFT JOIN calendar ON date_key = order_date_key
            GROUP BY ALL
        ), spans AS (
            SELECT *, (last_order_date - first_order_date)::BIGINT AS span,
                revenue::DOUBLE / nullif(completed_orders, 0)::DOUBLE AS average FROM history
        )
        SELECT canonical_customer_id, first_name, last_name, email, country_code, total_orders,
            completed_orders, revenue AS lifetime_revenue_usd,
            round(average, 2) AS avg_order_value_usd, discount AS lifetime_discount,
            first_order_date, last_order_date, coalesce(span, 0) AS customer_tenure_days,
            (DATE '{AS_OF}' - last_order_date)::BIGINT AS days_since_last_order,
            round(average * (completed_orders::DOUBLE / greatest(span, 1)::DOUBLE * 90), 2)
                AS estimated_clv_90d
        FROM spans""",
    "metric_order_conversion_rate": f"""
        SELECT full_date AS order_date, count(*) AS total_orders,
            count(*) FILTER (NOT is_cancelled) AS non_cancelled_orders,
            count(*) FILTER (is_paid) AS paid_orders,
            count(*) FILTER (is_cancelled) AS cancelled_orders,
            sum(total_amount_usd)::{WIDE} AS total_gmv_usd,
            coalesce(sum(total_amount_usd) FILTER (is_paid), 0)::{WIDE} AS paid_revenue_usd,
            round(non_cancelled_orders::DOUBLE / total_orders, 4) AS non_cancel_rate,
            round(paid_orders::DOUBLE / total_orders, 4) AS payment_conversion_rate,
            round(cancelled_orders::DOUBLE / total_orders, 4) AS cancellation_rate
        FROM fact_orders JOIN calendar ON date_key = order_date_key GROUP BY full_date""",
    "attributed": f"""
        SELECT campaign_id, sum(total_amount_usd)::{WIDE} AS attributed_revenue_usd,
            count(DISTINCT order_id) AS attributed_orders
        FROM fact_email_engagement e
        JOIN calendar sent ON sent.date_key = e.send_date_key
        JOIN fact_orders o USING (customer_sk)
        JOIN calendar placed ON placed.date_key = o.order_date_key
        WHERE o.is_cancelled = false AND placed.full_date - sent.full_date BETWEEN 0 AND 7
        GROUP BY campaign_id""",
    "metric_revenue_by_campaign": f"""
        WITH mail AS (
            SELECT campaign_id, min(campaign_name) AS mail_name, count(*) AS total_sends,
                count(*) FILTER (is_delivered) AS delivered, count(*) FILTER (is_opened) AS opened,
                count(*) FILTER (is_clicked) AS clicked
            FROM fact_email_engagement GROUP BY campaign_id
        ), paid AS (
            SELECT campaign_id, min(campaign_name) AS paid_name, sum(spend)::{WIDE} AS total_spend,
                sum(impressions)::BIGINT AS total_impressions, sum(clicks)::BIGINT AS paid_clicks,
                sum(conversions)::BIGINT AS total_conversions,
                sum(reported_revenue)::{WIDE} AS paid_reported_revenue
            FROM fact_campaign_performance GROUP BY campaign_id
        ), sides AS (SELECT * FROM mail FULL JOIN paid USING (campaign_id))
        SELECT campaign_id, coalesce(mail_name, paid_name) AS campaign_name, total_sends,
            delivered, opened, clicked, total_spend, total_impressions, paid_clicks,
            total_conversions, paid_reported_revenue,
            coalesce(attributed_orders, 0) AS attributed_orders,
            coalesce(a.attributed_revenue_usd, 0)::{WIDE} AS attributed_revenue_usd,
            round(coalesce(a.attributed_revenue_usd, 0)::DOUBLE
                  / nullif(total_spend::DOUBLE, 0), 2) AS attributed_roas
        FROM sides LEFT JOIN attributed a USING (campaign_id)""",
    "metric_inventory_turnover": f"""
        WITH sold AS (
            SELECT product_sk, sum(quantity)::BIGINT AS units_sold,
                sum(line_total)::{WIDE} AS total_sales_revenue,
                sum(gross_profit)::{WIDE} AS total_gross_profit
            FROM fact_order_items
            WHERE order_sk IN (SELECT order_sk FROM fact_orders WHERE is_cancelled = false)
            GROUP BY product_sk
        ), stock AS (
            SELECT product_sk, sum(on_hand_qty)::BIGINT AS total_on_hand,
                sum(available_qty)::BIGINT AS total_available,
                sum(reserved_qty)::BIGINT AS total_reserved,
                bool_or(is_below_reorder) AS any_below_reorder,
                sum(inventory_value)::{WIDE} AS total_inventory_value
            FROM fact_inventory_daily GROUP BY product_sk
        ), coming AS (
            SELECT product_sk, sum(ordered_qty - received_qty)::BIGINT AS incoming, count(*) AS pos
            FROM fact_purchase_orders WHERE po_status <> 'received' GROUP BY product_sk
        )
        SELECT product_sk, product_id, sku, product_name, category_standardized, units_sold,
            total_sales_revenue, total_gross_profit, total_on_hand, total_available,
            total_reserved, any_below_reorder, total_inventory_value,
            round((units_sold * unit_cost)::DOUBLE / nullif(total_inventory_value, 0)::DOUBLE, 4)
                AS inventory_turnover_ratio,
            round(total_on_hand::DOUBLE / nullif(units_sold, 0), 1) AS days_of_supply,
            coalesce(incoming, 0) AS incoming_supply_qty, coalesce(pos, 0) AS open_po_count
        FROM sold JOIN dim_products USING (product_sk)
        LEFT JOIN stock USING (product_sk) LEFT JOIN coming USING (product_sk)""",
    "dim_date": "SELECT * FROM calendar",
    "seed_exchange_rates": "SELECT code AS currency, rate FROM fx",
}


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"\b\w+\b", text))
    return [name for name in STEPS if name in words]


def _with_steps(final: str) -> str:
    """``final`` preceded by the steps it needs, in dependency order."""
    order: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in _needs(text):
            if name != own and name not in order:
                visit(STEPS[name], name)
                order.append(name)

    visit(final)
    if final.startswith("WITH"):
        final = f"SELECT * FROM ({final})"
    steps = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in order)
    return f"WITH {steps}\n{final}" if order else final


def _union(parts) -> str:
    return "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


ORACLES: dict[str, str] = {}


def _add(name: str, final: str) -> None:
    ORACLES[name] = _with_steps(final)


for _query, _table in MODELS.items():
    _add(_query, f"SELECT * FROM {_table}")

# sources

_add(
    "bronze_partition",
    "SELECT * FROM b_email_sends WHERE send_date = DATE '2024-01-15'",
)
_add(
    "csv_extract_typed",
    """SELECT * REPLACE (
        CASE WHEN customer_id % 5 = 0 THEN (send_date + INTERVAL 1 DAY)::DATE ELSE send_date END AS send_date,
        CASE WHEN customer_id % 7 = 0 THEN NULL ELSE campaign_name END AS campaign_name,
        date_trunc('second', loaded_at) AS loaded_at),
        'said "' || campaign_id || '", twice' AS batch_note
    FROM b_email_sends""",
)
_SENDS_SIGNATURE = (
    "send_date:datetime64[ns]|campaign_id:object|campaign_name:object|recipient_email:object|customer_id:int64"
    "|delivery_status:object|open_flag:bool|click_flag:bool|unsubscribe_flag:bool|load_filename:object"
    "|loaded_at:datetime64[ns]"
)
_add(
    "ingest_log",
    f"""SELECT 'r1' AS run_id, 'marketing' AS source, 'email_sends' AS entity, 'success' AS status,
        (SELECT count(*) FROM b_email_sends) AS rows_ingested, (SELECT count(*) FROM b_email_sends) AS landed,
        left(sha256('{_SENDS_SIGNATURE}'), 16) AS schema_hash,
        '{",".join(part.split(":")[0] for part in _SENDS_SIGNATURE.split("|"))}' AS schema_columns,
        false AS has_error, true AS timed
    UNION ALL SELECT 'r1', 'inventory', 'purchase_orders', 'failed', 0, 0, '', '', true, true""",
)
_add(
    "json_extract_typed",
    """SELECT *, CASE WHEN order_id % 100 = 1 THEN 'v' || order_id END AS voucher
    FROM b_payment_transactions""",
)
_add("json_array_typed", "SELECT * FROM b_payment_transactions")
_add(
    "csv_orders_typed",
    """SELECT * REPLACE (date_trunc('second', order_date) AS order_date,
        date_trunc('second', updated_at) AS updated_at) FROM b_orders""",
)
_add("csv_inventory_typed", "SELECT * FROM b_inventory_snapshot")
_add(
    "bronze_unknown_columns",
    """WITH sends AS (SELECT 'n' || customer_id % 10 AS other FROM b_email_sends),
        vouchers AS (
            SELECT CASE WHEN order_id % 100 = 1 THEN 'v' || order_id END AS other FROM b_payment_transactions),
        days AS (
            SELECT * FROM (VALUES ('landed', '2024-01-01', false), ('landed', '2024-01-02', true),
                ('bronze', '2024-01-02', true)) d(layer, dt, more))
    SELECT layer, 'email_sends' AS table_name, dt, count(*) AS row_count,
        count(CASE WHEN more THEN other END) AS filled, count(DISTINCT CASE WHEN more THEN other END) AS different,
        max(CASE WHEN more THEN other END) AS greatest
    FROM days, sends GROUP BY ALL
    UNION ALL
    SELECT layer, 'payment_transactions', dt, count(*), count(CASE WHEN more THEN other END),
        count(DISTINCT CASE WHEN more THEN other END), max(CASE WHEN more THEN other END)
    FROM days, vouchers GROUP BY ALL""",
)
_KEYS = ",".join(f.name for e in ENTITIES if e.table == "payment_transactions" for f in e.schema)
_add(
    "json_extract_drift",
    f"""SELECT dt, keys AS schema_columns, (SELECT count(*) FROM b_payment_transactions) AS row_count, drifted
    FROM (VALUES ('2024-01-01', '{_KEYS}', false), ('2024-01-02', '{_KEYS},voucher', true)) t(dt, keys, drifted)""",
)
_add(
    "landing_roundtrip",
    "SELECT strftime(send_date, '%Y-%m-%d') AS dt, count(*) AS row_count,"
    " sum(customer_id)::BIGINT AS customer_sum, count(*) FILTER (open_flag) AS opened"
    " FROM b_email_sends GROUP BY send_date",
)
_add(
    "landing_empty_guard",
    _union(
        f"SELECT '{name}' AS entity, count(*) AS rows_ingested, count(*) > 0 AS admissible FROM {src}"
        for name, src in (
            ("email_sends", "b_email_sends"),
            ("late_sends", "b_email_sends WHERE send_date > DATE '2100-01-01'"),
            ("customers", "b_customers"),
        )
    ),
)
_PAIRS = ", ".join(f"('{e.source}', '{e.name}')" for e in ENTITIES)
_add(
    "load_request_check",
    "SELECT r.* EXCLUDE (known), reason FROM (SELECT *, coalesce((source, entity) IN ("
    + _PAIRS
    + """), false) AS known FROM b_load_requests) r,
    (VALUES ('bad date'), ('blank entity'), ('unknown source'), ('unknown entity')) t(reason)
    WHERE CASE reason
        WHEN 'bad date' THEN NOT coalesce(
            regexp_full_match(partition_date, '\\d{4}-\\d{2}-\\d{2}')
            AND try_cast(partition_date AS DATE) IS NOT NULL, false)
        WHEN 'blank entity' THEN trim(coalesce(entity, '')) = ''
        WHEN 'unknown source' THEN source NOT IN ('postgres', 'payments', 'marketing', 'inventory')
        ELSE source IN ('postgres', 'payments', 'marketing', 'inventory') AND NOT known
            AND trim(coalesce(entity, '')) <> '' END""",
)
_add(
    "ingestion_log",
    _union(
        f"SELECT '{e.source}' AS source, '{e.name}' AS entity,"
        f" CASE WHEN count(*) > 0 THEN 'success' ELSE 'failed' END AS status,"
        f" count(*) AS rows_ingested FROM b_{e.table}"
        for e in ENTITIES
    ),
)


def _profile(table: str, columns: list[str], dates: tuple[str, ...], by: str) -> str:
    """Profile with implied types, one row per group and column."""
    parts = []
    for position, column in enumerate(columns):
        text = f'"{column}"::VARCHAR'
        day = (
            f"regexp_matches({text}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}')"
            f" AND try_cast({text} AS TIMESTAMP) IS NOT NULL"
        )
        dated = f"WHEN date_like = non_null THEN 'datetime64[ns]'" if column in dates else ""
        parts.append(
            f"""SELECT *, CASE {dated} WHEN non_null = 0 THEN 'float64'
                    WHEN bool_like = non_null AND non_null = row_count THEN 'bool'
                    WHEN bool_like = non_null THEN 'object'
                    WHEN int_like = non_null AND non_null = row_count THEN 'int64'
                    WHEN double_like = non_null THEN 'float64' ELSE 'object' END AS dtype
                FROM (SELECT {by} AS grp, {position}::INT AS position, '{column}' AS column_name,
                    count(*) AS row_count, count({text}) AS non_null,
                    count(*) FILTER (regexp_full_match({text}, '[+-]?\\d+')) AS int_like,
                    count(*) FILTER (try_cast({text} AS DOUBLE) IS NOT NULL) AS double_like,
                    count(*) FILTER (lower({text}) IN ('true', 'false')) AS bool_like,
                    count(*) FILTER ({day}) AS date_like, 0::BIGINT AS zoned
                FROM {table} GROUP BY ALL)"""
        )
    return _union(parts)


_HASHED = """SELECT grp, left(sha256(string_agg(column_name || ':' || dtype, '|' ORDER BY position)), 16)
        AS schema_hash, string_agg(column_name, ',' ORDER BY position) AS schema_columns
    FROM ({profile}) GROUP BY grp"""
_EVENTS = _profile(
    "b_event_texts", "event_id ts user_id event_type value props".split(), ("ts",), "dt"
)
_add("schema_profile", f"SELECT * EXCLUDE (grp), grp AS dt FROM ({_EVENTS})")
_add(
    "schema_drift",
    f"""SELECT 'events' AS entity, grp AS dt, schema_hash, schema_columns,
        lag(schema_hash) OVER (ORDER BY grp) AS previous_hash,
        coalesce(lag(schema_hash) OVER (ORDER BY grp) <> schema_hash, false) AS drifted
        FROM ({_HASHED.format(profile=_EVENTS)})""",
)
_INPUTS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount"
    " l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
}
_add(
    "schema_fingerprint",
    "SELECT grp AS table_name, schema_hash, schema_columns FROM ("
    + _HASHED.format(
        profile=_union(
            _profile(t, cols.split(), ("o_orderdate", "l_shipdate", "ts"), f"'{t}'")
            for t, cols in _INPUTS.items()
        )
    )
    + ")",
)
_add(
    "seed_category",
    """SELECT raw AS category_raw, nice AS category_standardized,
        (SELECT count(*) FROM stg_products WHERE category_raw = raw) AS products FROM category""",
)
_add(
    "seed_fx",
    """SELECT code AS currency, rate AS rate_to_usd,
        (SELECT count(*) FROM stg_orders WHERE currency = code) AS orders FROM fx""",
)
_STEP_OF = {e.table: f"b_{e.table}" for e in ENTITIES}
_STEP_OF |= {"seed_category_mapping": "category", "seed_exchange_rates": "fx"}
_add(
    "table_stats",
    "SELECT layer, table_name, sum(n)::BIGINT AS row_count FROM ("
    + _union(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS n FROM {_STEP_OF.get(name, name)}"
        for layer, names in LAYERS.items()
        for name in names
    )
    + ") GROUP BY ROLLUP (layer, table_name)",
)
ORACLES["stored_tables"] = ORACLES["table_stats"]
_BUILT = ("dim_date", "dim_customers", "dim_products", "fact_orders")
_add(
    "missing_tables",
    "SELECT name AS table_name FROM (VALUES "
    + ", ".join(f"('{n}')" for n in GOLD)
    + ") w(name) WHERE name NOT IN (SELECT t FROM ("
    + _union(f"SELECT '{n}' AS t, count(*) AS n FROM {n}" for n in _BUILT)
    + ") WHERE n > 0)",
)

# dimensions and operators

_add(
    "dim_date",
    """WITH ends AS (
        SELECT least(min(o_orderdate), (SELECT min(l_shipdate) FROM lineitem))::DATE AS lo,
            greatest(max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem))::DATE AS hi
        FROM orders
    ), days AS (SELECT unnest(range(lo, hi + 1, INTERVAL 1 DAY))::DATE AS d FROM ends)
    SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, d AS full_date,
        isodow(d)::INT AS day_of_week, dayname(d) AS day_name, week(d)::INT AS week_of_year,
        month(d)::INT AS month_num, monthname(d) AS month_name, quarter(d)::INT AS quarter,
        year(d)::INT AS year, isodow(d) > 5 AS is_weekend,
        quarter(d + INTERVAL 6 MONTH)::INT AS fiscal_quarter,
        year(d + INTERVAL 6 MONTH)::INT AS fiscal_year
    FROM days""",
)
_add("campaign_attribution", "SELECT * FROM attributed")
_add(
    "attribution_pairs",
    """SELECT email_sk, order_sk, (placed.full_date - sent.full_date)::INT AS days
    FROM fact_email_engagement e
    JOIN calendar sent ON sent.date_key = e.send_date_key
    JOIN fact_orders o USING (customer_sk)
    JOIN calendar placed ON placed.date_key = o.order_date_key
    WHERE o.is_cancelled = false AND placed.full_date - sent.full_date BETWEEN 0 AND 7""",
)
_add(
    "dense_key_hot",
    """SELECT row_number() OVER (ORDER BY group_key, l_returnflag, ship_day, l_orderkey, l_linenumber) AS row_sk, *
    FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS group_key, l_returnflag,
        l_shipdate::DATE AS ship_day, l_orderkey, l_linenumber FROM lineitem)""",
)
_add(
    "dense_key_lineitem",
    """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_sk, *
    FROM lineitem""",
)

# quality


def _check(check_id, category, table, description, failing, details="''") -> str:
    return (
        f"SELECT '{check_id}' AS check_id, '{category}' AS category, '{table}' AS table_name,"
        f" '{description}' AS description, n = 0 AS passed, n AS failing_rows, {details} AS details"
        f" FROM ({failing})"
    )


def _bare(name: str) -> str:
    return name.split(".")[1]


def _quote(text: str) -> str:
    return text.replace("'", "''")


_ROWS = {
    r.check_id: _check(
        r.check_id,
        r.category,
        r.table,
        _quote(r.description),
        f"SELECT count(*) AS n FROM {_bare(r.table)} WHERE {r.fails.replace('`', '')}",
    )
    for r in specs.row_rules()
}
_NULLS = [sql for key, sql in _ROWS.items() if key.startswith("null_")]
_ARITHMETIC = [sql for key, sql in _ROWS.items() if key.startswith("arith_")]
_DUPLICATES = [
    _check(
        f"dup_{t}.{c}",
        "duplicate",
        t,
        f"{c} is unique",
        f"SELECT count(*) AS total, count(DISTINCT {c}) AS different, total - different AS n"
        f" FROM {_bare(t)}",
        "CASE WHEN n > 0 THEN concat(total, ' total, ', different, ' distinct') ELSE '' END",
    )
    for t, columns in specs.UNIQUE.items()
    for c in columns
]
_REFERENCES = []
for _child, _links in specs.REFERENCES.items():
    for _column, _parent, _key in _links:
        _target = f"{_parent}.{_key}"
        _REFERENCES.append(
            _check(
                f"fk_{_child}.{_column}__{_target}",
                "referential",
                _child,
                f"{_column} → {_target}",
                f"SELECT count(*) AS n FROM {_bare(_child)} WHERE {_column} IS NOT NULL"
                f" AND {_column} NOT IN (SELECT {_key} FROM {_bare(_parent)})",
            )
        )
_CURRENCY = [
    _check(
        "currency_order_payment_match",
        "currency",
        "gold.fact_orders ↔ gold.fact_payments",
        "order currency equals payment currency",
        "SELECT count(*) AS n FROM fact_orders a JOIN fact_payments b"
        " ON a.order_sk = b.order_sk AND a.currency <> b.currency",
    ),
    _check(
        "currency_known_rate",
        "currency",
        "gold.fact_orders",
        "every order currency has an exchange rate",
        "SELECT count(DISTINCT currency) AS n FROM fact_orders"
        " WHERE currency NOT IN (SELECT code FROM fx)",
    ),
    _ROWS["currency_usd_conversion_positive"],
]

def _schema(table: str, columns, source: str, details: str | None = None) -> str:
    """A schema check by the types that DuckDB's own table has, with its rows."""
    wanted = [(c, "BIGINT" if t == "ID" else t) for c, t in columns]
    wrong = ", ".join(
        f"CASE WHEN any_value(typeof({c})) <> '{t}' THEN concat('{c}: expected {t}, got ', any_value(typeof({c}))) END"
        for c, t in wanted
    )
    found = details or (
        "CASE WHEN len(wrong) > 0 THEN concat('type mismatches: [''',"
        " array_to_string(wrong, ''', '''), ''']') ELSE '' END"
    )
    return (
        f"SELECT 'schema_{table}' AS check_id, 'schema' AS category, '{table}' AS table_name,"
        f" 'Schema matches expected definition' AS description, {found} = '' AS passed,"
        f" 0::BIGINT AS failing_rows, {found} AS details, n AS row_count"
        f" FROM (SELECT count(*) AS n, list_filter([{wrong}], lambda x: x IS NOT NULL) AS wrong FROM {source})"
    )


_SCHEMA = [_schema(t, columns, _bare(t)) for t, columns in specs.SCHEMAS.items()]
_RETYPED = ", ".join(f"{c}::{t} AS {c}" for c, t in RETYPED.items())
_SCHEMA_FAULTS = [
    _schema(
        t,
        [(c, k) for c, k in columns if (t, c) != ("gold.dim_products", "sku")],
        f"(SELECT * REPLACE ({_RETYPED}) FROM fact_orders)" if t == "gold.fact_orders" else _bare(t),
        "'missing columns: [''sku'']'" if t == "gold.dim_products" else None,
    )
    for t, columns in specs.SCHEMAS.items()
]
_add("dq_nulls", _union(_NULLS))
_add("dq_arithmetic", _union(_ARITHMETIC))
_add(
    "report_roundtrip",
    f"""WITH checks AS ({_union(_ARITHMETIC)})
    SELECT *, 'r2' AS run_id, (SELECT count(*) FROM checks)::VARCHAR AS total,
        (SELECT count(*) FROM checks WHERE passed)::VARCHAR AS n_passed,
        (SELECT count(*) FROM checks WHERE NOT passed)::VARCHAR AS n_failed FROM checks""",
)
_add("dq_nonnegative", _union(s for k, s in _ROWS.items() if k.startswith("arith_nonneg_")))
_add("dq_duplicates", _union(_DUPLICATES))
_add("dq_references", _union(_REFERENCES))
_add("dq_currency", _union(_CURRENCY))


def _orphaned(sql: str) -> str:
    """The same check with the parent's rows left that are kept."""
    for parent, kept in KEPT_PARENTS.items():
        sql = re.sub(rf"(NOT IN \(SELECT \w+ FROM {parent})\)", rf"\1 WHERE {kept})", sql)
    return sql


def _turned(sql: str) -> str:
    for table, (_, columns) in TURNED_AMOUNTS.items():
        replaced = ", ".join(f"{turned(table, c)} AS {c}" for c in columns)
        sql = sql.replace(f"AS n FROM {table} ", f"AS n FROM (SELECT * REPLACE ({replaced}) FROM {table}) ")
    return sql


_add("dq_references_orphans", _union(map(_orphaned, _REFERENCES)))
_add("dq_amount_faults", _union(map(_turned, _ARITHMETIC)))
_add("dq_schema", _union(_SCHEMA))
_add("dq_schema_faults", _union(_SCHEMA_FAULTS))


def _repeated(name: str, sql: str) -> str:
    """The same check over the table with repeated rows and lost keys."""
    key, number = repeats(name)
    table = _bare(name)
    rows = (
        f"(SELECT * REPLACE (CASE WHEN {number} % 40 <> 2 THEN {key} END AS {key}) FROM {table}"
        f" UNION ALL SELECT * FROM {table} WHERE {number} % 40 = 1)"
    )
    return sql.replace(f" FROM {table})", f" FROM {rows})")


_add(
    "dq_duplicates_planted",
    _union(_repeated(name, sql) for name, sql in zip((t for t, cs in specs.UNIQUE.items() for _ in cs), _DUPLICATES)),
)
_add(
    "dq_summary",
    "SELECT category, count(*) AS total, count(*) FILTER (passed) AS passed,"
    " count(*) FILTER (NOT passed) AS failed, bool_and(passed) AS all_passed FROM ("
    + _union(
        f"SELECT category, passed FROM ({part})"
        for part in (*_NULLS, *_ARITHMETIC, *_DUPLICATES, *_REFERENCES, *_CURRENCY, *_SCHEMA)
    )
    + ") GROUP BY category",
)

# histories

_RUNS = """SELECT pipeline_run_id, dag_id, count(*) AS total_tasks,
    count(*) FILTER (status = 'success') AS succeeded,
    count(*) FILTER (status <> 'success') AS failed,
    round((epoch_us(max(end_time)) - epoch_us(min(start_time))) / 1e6, 3) AS elapsed_seconds
    FROM b_tasks GROUP BY ALL"""
_add("run_history", _RUNS)
_add(
    "run_success_rate",
    f"""SELECT count(*) AS total_runs, count(*) FILTER (failed > 0) AS failed_runs,
        round_even(count(*) FILTER (failed = 0)::DOUBLE / count(*)::DOUBLE * 100, 0)
            AS success_rate_pct
        FROM ({_RUNS})""",
)
_add(
    "task_duration",
    """SELECT task_id, round(sum(d)::DOUBLE / count(d), 3) AS avg_seconds, count(d) AS runs
    FROM (SELECT task_id, try_cast(duration_seconds AS DECIMAL(18,3)) AS d FROM b_tasks)
    WHERE d IS NOT NULL GROUP BY task_id""",
)
_add("task_history", "SELECT * REPLACE (coalesce(error, '') AS error) FROM b_tasks")
_add(
    "failure_log",
    "SELECT pipeline_run_id, dag_id, task_id, status, attempts, coalesce(error, '') AS error"
    " FROM b_tasks WHERE status <> 'success'",
)
_add(
    "volume_by_source",
    """WITH kept AS (
        SELECT * FROM b_load_log WHERE status = 'success'
            OR NOT EXISTS (SELECT 1 FROM b_load_log WHERE status = 'success'))
    SELECT source, sum(rows_ingested)::BIGINT AS rows_ingested FROM kept GROUP BY source
    UNION ALL SELECT 'TOTAL', sum(rows_ingested)::BIGINT FROM kept""",
)
_add(
    "dq_trend",
    """SELECT run_id, count(*) AS total, count(*) FILTER (passed) AS passed,
        count(*) FILTER (NOT passed) AS failed,
        round_even(count(*) FILTER (passed)::DOUBLE / count(*)::DOUBLE * 100, 0) AS pass_rate_pct
    FROM b_check_reports GROUP BY run_id""",
)
for _query in ("latest_failures", "newest_report_failures"):
    _add(
        _query,
        """SELECT * FROM b_check_reports WHERE NOT passed
            AND run_id = (SELECT max(run_id) FROM b_check_reports)""",
    )
