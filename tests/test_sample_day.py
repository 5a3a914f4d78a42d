"""Golden results of the sample day."""

from datetime import date
from decimal import Decimal as D

from cartwright.plans.warehouse import GOLD, LAYERS, missing_tables, table_stats


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_all_entities_landed(sample_day):
    log = sample_day[1].collect()
    assert [r.status for r in log] == ["success"] * 9, [r.error_message for r in log]
    assert sum(r.rows_ingested for r in log) == 50


def test_row_counts(spark, warehouse):
    tables = {layer: {n: warehouse.table(n) for n in names} for layer, names in LAYERS.items()}
    stats = {(r.layer, r.table_name): r.row_count for r in table_stats(tables).collect()}
    assert stats[("bronze", None)] == 50
    assert stats[("silver", None)] == 60  # and two seeds of 8 and 2 rows
    assert stats[("gold", "dim_date")] == 1461
    assert stats[("gold", "metric_customer_lifetime_value")] == 5
    assert stats[("gold", "metric_revenue_by_campaign")] == 3
    assert stats[("gold", "metric_inventory_turnover")] == 4
    assert stats[(None, None)] == 50 + 60 + 1524
    assert len([k for k in stats if k[1]]) == 34
    assert missing_tables(spark, table_stats(tables)).count() == 0
    fewer = {"gold": {n: t for n, t in tables["gold"].items() if n != "dim_date"}}
    assert [r[0] for r in missing_tables(spark, table_stats(fewer), GOLD).collect()] == ["dim_date"]


def test_order_values(warehouse):
    # 3510 pesos at 0.0178 are 62.478 dollars.
    assert rows(warehouse.fact_orders, "order_id", "order_sk", "total_amount_usd") == [
        (201, 1, D("108.50")),
        (202, 2, D("29.40")),
        (203, 3, D("79.20")),
        (204, 4, D("72.00")),
        (205, 5, D("62.48")),
        (206, 6, D("25.00")),
        (207, 7, D("60.00")),
    ]
    assert warehouse.fact_orders.where("has_total_mismatch").count() == 0
    assert warehouse.fact_order_items.where("has_line_total_mismatch").count() == 0


def test_customers(warehouse):
    assert rows(warehouse.dim_customers, "customer_id", "canonical_customer_id") == [
        (31, 31),
        (33, 33),
        (35, 35),
        (36, 33),
        (38, 38),
        (40, 40),
    ]
    # Keys follow the canonical id, then the id.
    assert rows(warehouse.dim_customers, "customer_sk", "customer_id") == [
        (1, 31),
        (2, 33),
        (3, 36),
        (4, 35),
        (5, 38),
        (6, 40),
    ]
    flagged = warehouse.stg_customers.where("is_duplicate_email")
    assert rows(flagged, "customer_id") == [(33,), (36,)]


def test_products(warehouse):
    assert rows(warehouse.dim_products, "sku", "category_standardized", "gross_margin_pct") == [
        ("LAMP-A", "Electronics", 60.0),
        ("PAN-D", "Homewares", 75.0),
        ("SANDAL-C", "Footwear", 72.5),
        ("SCARF-B", "Accessories", 75.0),
        ("TENT-E", "Uncategorized", 75.0),
    ]


def test_lifetime_value(warehouse):
    found = warehouse.metric_customer_lifetime_value.select(
        "canonical_customer_id",
        "total_orders",
        "completed_orders",
        "lifetime_revenue_usd",
        "avg_order_value_usd",
        "lifetime_discount",
        "customer_tenure_days",
        "days_since_last_order",
        "estimated_clv_90d",
    )
    # Everything was ordered on one day, so orders count as orders a day.
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {
        31: (3, 2, D("133.50"), 66.75, D("9.00"), 0, 2, 12015.0),
        33: (2, 2, D("108.60"), 54.3, D("8.00"), 0, 2, 9774.0),
        35: (1, 0, D("0.00"), None, D("0.00"), 0, 2, None),
        38: (0, 0, D("0.00"), None, D("0.00"), 0, None, None),
        40: (1, 1, D("62.48"), 62.48, D("600.00"), 0, 2, 5623.2),
    }


def test_conversion(warehouse):
    result = warehouse.metric_order_conversion_rate.drop("_computed_at")
    # Seven orders: five kept, four of them paid, two cancelled.
    assert [tuple(r) for r in result.collect()] == [
        (date(2026, 5, 18), 7, 5, 4, 2, D("436.58"), D("279.58"), 0.7143, 0.5714, 0.2857)
    ]


def test_campaigns(warehouse):
    result = warehouse.metric_revenue_by_campaign
    reached = result.where("campaign_id = 'MAIL-X'").first()
    assert (reached.total_sends, reached.delivered, reached.opened, reached.clicked) == (5, 4, 3, 1)
    # 201 and 206 of Noor, 202 of Tomas (not 203, of the id without a mail), 205 of Ira.
    assert (reached.attributed_orders, reached.attributed_revenue_usd) == (4, D("225.38"))
    assert reached.attributed_roas is None and reached.total_spend is None
    paid = result.where("campaign_id <> 'MAIL-X'").collect()
    assert len(paid) == 2
    for r in paid:
        assert (r.attributed_orders, r.attributed_revenue_usd) == (0, D("0.00"))
        assert (r.attributed_roas, r.total_sends) == (0.0, None)


def test_campaign_ratios(warehouse):
    assert rows(warehouse.fact_campaign_performance, "campaign_id", "ctr", "cpc", "cpa", "roas") == [
        ("PAY-1", 0.05, 0.40, 25.0, 5.0),
        ("PAY-2", 0.08, 0.75, 30.0, 2.5),
    ]


def test_turnover(warehouse):
    # The pan was only in a cancelled order.
    assert rows(
        warehouse.metric_inventory_turnover,
        "product_id",
        "units_sold",
        "total_sales_revenue",
        "total_gross_profit",
        "total_on_hand",
        "total_inventory_value",
        "inventory_turnover_ratio",
        "days_of_supply",
        "any_below_reorder",
        "incoming_supply_qty",
        "open_po_count",
    ) == [
        (501, 2, D("95.00"), D("55.00"), 40, D("800.00"), 0.05, 20.0, True, 30, 1),
        (502, 2, D("44.00"), D("32.00"), 80, D("480.00"), 0.025, 40.0, False, 0, 0),
        (503, 2, D("72.00"), D("50.00"), 16, D("176.00"), 0.125, 8.0, False, 100, 1),
        (505, 1, D("3000.00"), D("2100.00"), 4, D("3600.00"), 0.25, 4.0, True, 6, 1),
    ]


def test_overdue(warehouse):
    assert rows(warehouse.fact_purchase_orders, "po_id", "is_overdue", "fill_rate") == [
        (71, False, 1.0),
        (72, True, 0.25),
        (73, False, 0.0),
        (74, True, 0.0),
    ]


def test_audit_columns(warehouse):
    for name in GOLD:
        if name.startswith("dim_date"):
            continue
        expected = "_computed_at" if name.startswith("metric_") else "_loaded_at"
        assert warehouse.table(name).columns[-1] == expected
