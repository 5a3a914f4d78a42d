"""Edges of the models that the sample day does not reach."""

import time
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartwright.plans import silver
from cartwright.plans.warehouse import BUILDING, Warehouse, lean_disk
from cartwright.sources.entities import ENTITIES

DAY = datetime(2026, 3, 10)


@pytest.fixture(scope="module")
def make(spark):
    """Bronze tables from short rows; columns that are not given are NULL."""

    def build(**rows):
        tables = {}
        for entity in ENTITIES:
            given = rows.get(entity.table, [])
            data = [tuple(r.get(f.name) for f in entity.schema) for r in given]
            tables[entity.table] = spark.createDataFrame(data, entity.schema)
        return tables

    return build


def order(order_id, customer_id, **more):
    base = dict(
        order_id=order_id, customer_id=customer_id, order_date=DAY, order_status="completed",
        currency="USD", subtotal_amount=D(10), discount_amount=D(0), shipping_amount=D(0),
        tax_amount=D(0), total_amount=D(10), payment_status="paid",
    )
    return {**base, **more}


@pytest.fixture(scope="module")
def edge(spark, make):
    tables = make(
        customers=[
            dict(customer_id=1, email=" A@x.com ", first_name="a", created_at=DAY),
            dict(customer_id=1, email="old@x.com", first_name="b", created_at=datetime(2020, 1, 1)),
            dict(customer_id=2, email=None, created_at=DAY),
            dict(customer_id=3, email=None, created_at=DAY),
            dict(customer_id=4, email="idle@x.com", created_at=DAY),
            dict(customer_id=5, email="lost@x.com", created_at=DAY),
        ],
        products=[
            dict(product_id=1, sku="S", category=" Shoes ", unit_cost=D("1.00"), list_price=D(0)),
            dict(product_id=2, sku="S", category="toys", unit_cost=D("1.00"), list_price=D("2.00")),
        ],
        orders=[
            order(1, 1),
            order(2, 1, order_date=datetime(2026, 3, 12), currency="EUR"),
            order(3, 2),
            order(4, 99),
            order(5, 5, order_status="CANCELLED "),
            order(6, 1, order_date=datetime(1999, 1, 1)),
            order(7, 1, order_status=None),
        ],
        purchase_orders=[
            dict(po_id=1, sku="S", ordered_qty=0, received_qty=0, unit_cost=D("1.50"), po_status="open",
                 created_at=DAY, expected_delivery_date=date(2026, 3, 15)),
            dict(po_id=2, sku="T", ordered_qty=4, received_qty=1, unit_cost=D("1.50"), po_status="OPEN",
                 created_at=DAY, expected_delivery_date=date(2026, 3, 14)),
        ],
        campaign_performance=[
            dict(campaign_date=date(2026, 3, 10), campaign_id="z", impressions=0, clicks=0,
                 spend=D(0), conversions=0, reported_revenue=D(0)),
        ],
    )
    return Warehouse(spark, tables, date(2026, 3, 15), loaded_at=DAY)


def test_customers_without_email_leave_the_dimension(edge):
    flags = {r.customer_id: r.is_duplicate_email for r in edge.stg_customers.collect()}
    assert flags == {1: False, 2: True, 3: True, 4: False, 5: False}
    kept = {r.customer_id: (r.email, r.first_name) for r in edge.dim_customers.collect()}
    assert set(kept) == {1, 4, 5} and kept[1] == ("a@x.com", "a")


def test_orders_keep_unknown_customers_days_and_currencies(edge):
    facts = {r.order_id: r for r in edge.fact_orders.collect()}
    assert len(facts) == 7
    assert facts[3].customer_sk is None and facts[4].customer_sk is None
    assert facts[6].order_date_key is None
    assert facts[2].total_amount_usd == D("10.00")
    assert facts[5].is_cancelled and facts[7].is_cancelled is None


def test_lifetime_value_edges(edge):
    people = {r.email: r for r in edge.metric_customer_lifetime_value.collect()}
    idle, lost, buyer = people["idle@x.com"], people["lost@x.com"], people["a@x.com"]
    assert (idle.total_orders, idle.lifetime_revenue_usd, idle.customer_tenure_days) == (0, D("0.00"), 0)
    assert idle.days_since_last_order is None and idle.estimated_clv_90d is None
    assert (lost.total_orders, lost.completed_orders, lost.avg_order_value_usd) == (1, 0, None)
    assert lost.last_order_date == date(2026, 3, 10)
    # An unknown status is neither cancelled nor kept; an undated order still counts.
    assert (buyer.total_orders, buyer.completed_orders) == (4, 3)
    assert (buyer.lifetime_revenue_usd, buyer.customer_tenure_days) == (D("30.00"), 2)
    assert buyer.estimated_clv_90d == 1350.0


def test_conversion_leaves_out_undated_orders(edge):
    total = edge.metric_order_conversion_rate.agg(F.sum("total_orders")).first()[0]
    assert total == 6


def test_zero_divisors_give_null(edge):
    campaign = edge.fact_campaign_performance.first()
    assert (campaign.ctr, campaign.cpc, campaign.cpa, campaign.roas) == (None,) * 4
    margins = {r.product_id: r.gross_margin_pct for r in edge.stg_products.collect()}
    assert margins == {1: None, 2: 50.0}


def test_a_repeated_sku_repeats_its_purchase_orders(edge):
    rows = edge.fact_purchase_orders.orderBy("po_sk").collect()
    assert [(r.po_id, r.product_sk) for r in rows] == [(1, 1), (1, 2), (2, None)]
    assert [r.fill_rate for r in rows] == [None, None, 0.25]
    # Due on the day itself is not overdue.
    assert [r.is_overdue for r in rows] == [False, False, True]


def test_flags_on_decimals_and_on_doubles(spark, make):
    tables = make(
        orders=[order(1, 1, subtotal_amount=D("100.01"), total_amount=D("100.00"))],
        order_items=[
            dict(order_item_id=1, quantity=1, unit_price=D("100.01"), discount_amount=D(0),
                 line_total=D("100.00"))
        ],
    )
    for exact, expected in ((True, False), (False, True)):
        orders = silver.stg_orders(tables["orders"], exact=exact)
        items = silver.stg_order_items(tables["order_items"], exact=exact)
        assert orders.first().has_total_mismatch is expected
        assert items.first().has_line_total_mismatch is expected


def test_latest_snapshot(spark, make):
    rows = [
        dict(snapshot_date=date(2026, 3, d), product_id=p, on_hand_qty=d)
        for d in (9, 10)
        for p in (1, 2)
    ]
    bronze = make(inventory_snapshot=rows)["inventory_snapshot"]
    newest = silver.latest_snapshot(silver.stg_inventory_snapshot(bronze))
    assert sorted((r.product_id, r.on_hand_qty) for r in newest.collect()) == [(1, 10), (2, 10)]


def test_wide_ids(spark, make):
    big = 5_000_000_000
    tables = make(orders=[order(big, 1)])
    wide = Warehouse(spark, tables, date(2026, 3, 15), loaded_at=DAY, id_type="bigint")
    assert wide.fact_orders.first().order_id == big
    narrow = Warehouse(spark, tables, date(2026, 3, 15), loaded_at=DAY)
    with pytest.raises(Exception, match="OVERFLOW"):
        narrow.stg_orders.collect()


def test_fact_plan_has_no_single_partition_sort(edge):
    text = edge.fact_orders._jdf.queryExecution().toString()
    assert "SinglePartition" not in text and "Window" not in text


def test_store_writes_catalogue_tables(spark, sample_day):
    from sample_day import AS_OF, DAY

    from cartwright.plans.warehouse import LAYERS, open_landing

    stored = open_landing(spark, sample_day[0], DAY, AS_OF).store()
    assert len(stored) == sum(map(len, LAYERS.values())) == 34
    assert spark.table("gold.fact_orders").count() == 7
    assert spark.table("gold.metric_revenue_by_campaign").count() == 3
    again = open_landing(spark, sample_day[0], DAY, AS_OF).store()
    assert again["fact_orders"].count() == 7


def test_a_failing_store_changes_nothing(spark, sample_day):
    from sample_day import AS_OF, DAY

    from cartwright.plans.publish import versions
    from cartwright.plans.warehouse import open_landing

    def store(fails=False, **more):
        shop = open_landing(spark, sample_day[0], DAY, AS_OF, **more)
        if fails:
            shop.__dict__["metric_inventory_turnover"] = shop.dim_date.selectExpr("raise_error('no metric') AS x")
        return shop.store(prefix="swap_")

    store()
    reader = spark.table("swap_gold.fact_orders")
    assert reader.count() == 7
    kept = {name: versions(spark, f"swap_{name}") for name in ("gold.fact_orders", "bronze.orders", "gold.dim_date")}
    with pytest.raises(Exception, match="no metric"):
        store(fails=True)
    assert {name: versions(spark, f"swap_{name}") for name in kept} == kept
    assert spark.table("swap_gold.fact_orders").count() == 7
    store(last_day=date(2028, 12, 31))
    assert spark.table("swap_gold.dim_date").count() == 1827
    # A query that began before the swap still reads its version.
    assert reader.count() == 7 and len(versions(spark, "swap_gold.fact_orders")) == 2
    store()
    assert len(versions(spark, "swap_gold.fact_orders")) == 2 and spark.table("swap_gold.dim_date").count() == 1461


def test_a_plain_table_becomes_a_version(spark):
    from cartwright.plans.publish import Publication, versions

    spark.sql("CREATE DATABASE IF NOT EXISTS old_style")
    spark.range(3).write.saveAsTable("old_style.t")
    one = Publication(spark)
    one.write(spark.range(5), "old_style.t")
    assert spark.table("old_style.t").count() == 3
    one.publish()
    assert spark.table("old_style.t").count() == 5 and versions(spark, "old_style.t")[0] == "old_style.t__before"


def test_what_follows_from_a_facts_columns_is_neither_shuffled_nor_written(make, spark):
    tables = make(orders=[order(1, 1), order(2, 1, order_status="cancelled", payment_status="open")])
    shop = Warehouse(spark, tables, date(2026, 3, 11))
    facts = shop.fact_orders
    assert [(r.order_id, r.is_cancelled, r.is_paid) for r in facts.orderBy("order_sk").collect()] == [(1, False, True), (2, True, False)]
    stored = spark.read.parquet(facts.inputFiles()[0]).columns
    assert "order_status" in stored and not {"is_cancelled", "is_paid"} & set(stored)


def test_customers_are_staged_once_for_their_key(make, spark):
    customers = [dict(customer_id=i, email=f"a{i % 2}@x.com", created_at=DAY) for i in range(1, 5)]
    shop = Warehouse(spark, make(customers=customers), date(2026, 3, 11))
    names = []
    stage = shop.scratch.stage
    shop.scratch.stage = lambda df, name: names.append(name) or stage(df, name)
    assert [r.canonical_customer_id for r in shop.dim_customers.orderBy("customer_sk").collect()] == [1, 1, 2, 2]
    assert names == ["stg_customers", "customer_sk"]


def test_lookups_hash_small_shares_only_while_models_are_built(spark):
    from cartwright.plans.warehouse import HASHED_SHARE, hashed_lookups

    before = spark.conf.get(HASHED_SHARE)
    with hashed_lookups(spark):
        assert spark.conf.get(HASHED_SHARE) == spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.conf.get(HASHED_SHARE) == before
    spark.conf.set(HASHED_SHARE, "1m")
    try:
        with hashed_lookups(spark):
            assert spark.conf.get(HASHED_SHARE) == "1m"
        assert spark.conf.get(HASHED_SHARE) == "1m"
    finally:
        spark.conf.unset(HASHED_SHARE)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffles_of_a_build_go_when_their_job_has_ended(make, spark):
    shop = Warehouse(spark, make(orders=[order(i, 1) for i in range(9)]), date(2026, 3, 11))
    before = shuffle_files(spark)
    shop.prepare("fact_orders")
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    # What reads the build keeps its shuffles as the session says.
    assert shop.fact_orders.groupBy("customer_sk").count().count() == 1


def test_settings_of_a_build_end_with_it_and_leave_the_sessions_own(spark):
    def now():
        return {key: spark.conf.get(key, None) for key in BUILDING}

    before = now()
    with lean_disk(spark):
        assert now() == BUILDING
    assert now() == before
    key = next(iter(BUILDING))
    spark.conf.set(key, "false")
    try:
        with lean_disk(spark):
            assert now() == {**BUILDING, key: "false"}
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)


def test_only_columns_that_are_kept_are_shuffled_to_the_dimensions(make, spark):
    customers = [dict(customer_id=i, email=f"a{i}@x.com", created_at=DAY) for i in range(1, 5)]
    products = [dict(product_id=1, sku="S")]
    shop = Warehouse(spark, make(customers=customers, products=products, orders=[order(1, 1)]), date(2026, 3, 11))
    plans, stage = {}, shop.scratch.stage
    shop.scratch.stage = lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or stage(df, name)
    shop.prepare("fact_payments", "fact_email_engagement", "fact_inventory_daily", "fact_purchase_orders")
    for name, key in (("order_sk", "customer_id"), ("payment_sk", "customer_id"), ("email_sk", "customer_id"),
                      ("inventory_sk", "product_id"), ("po_sk", "sku")):
        joins = [line for line in plans[name].splitlines() if "Join LeftOuter" in line]
        # The calendar and the rates are joined below the dimensions.
        assert len(joins) > 1 and f"({key}#" in joins[0], joins


def test_copies_are_compressed_and_go_once_their_model_is_stored(make, spark, monkeypatch):
    from cartwright.plans.publish import Publication

    shop = Warehouse(spark, make(orders=[order(1, 1)]), date(2026, 3, 11))
    staged, write = {}, Publication.write

    def noted(self, df, full_name):
        staged[full_name.split(".")[1]] = {name for name, _ in shop.scratch._staged.values()}
        stored = write(self, df, full_name)
        assert all(path.endswith(".zstd.parquet") for path in stored.inputFiles())
        return stored

    monkeypatch.setattr(Publication, "write", noted)
    stored = shop.store(prefix="copies_")
    assert stored["fact_orders"].count() == 1
    assert "order_sk" in staged["fact_orders"] and "customer_sk" not in staged["fact_orders"]
    assert staged["metric_order_conversion_rate"] == set()
    copy = Warehouse(spark, make(orders=[order(1, 1)]), date(2026, 3, 11)).fact_orders
    assert copy.inputFiles()[0].endswith(".zstd.parquet")


def test_a_metric_that_was_asked_for_before_a_store_still_finds_its_copies(make, spark):
    shop = Warehouse(spark, make(orders=[order(1, 1)]), date(2026, 3, 11))
    asked = shop.metric_order_conversion_rate
    assert asked.agg(F.sum("total_orders")).first()[0] == 1
    assert shop.store(prefix="asked_")["metric_order_conversion_rate"].agg(F.sum("total_orders")).first()[0] == 1
