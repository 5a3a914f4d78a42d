"""Registered queries: each runs one model, operator or report over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import history
from cartwright.operators import dense_key, with_row_tag, within_days
from cartwright.operators.dense_key import ROW_TAG
from cartwright.plans import dims
from cartwright.plans.metrics import attributed_revenue, with_day
from cartwright.plans.warehouse import GOLD, KEYED, LAYERS, missing_tables, table_stats
from cartwright.quality import Checks, append_report, latest_failures, specs, summary
from cartwright.quality.report import newest_report
from cartwright.registry.roles import ID_TYPE, KEPT_PARENTS, RETYPED, TURNED_AMOUNTS, repeats, role, shop, turned
from cartwright.sources import landing, loads, profile
from cartwright.sources.entities import BY_TABLE, ENTITIES
from cartwright.sources.files import read_entity, read_text
from cartwright.sources.scratch import Scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AUDIT = ("_loaded_at", "_computed_at")


def query(function: Query, name: str | None = None) -> Query:
    QUERIES[name or function.__name__] = function
    return function


def named(name: str) -> Callable[[Query], Query]:
    """Register a query whose name is taken by what it calls."""
    return lambda function: query(function, name)


def _model(query_name: str, table: str) -> None:
    """Register a warehouse table without its audit column."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        shop_ = shop(spark, folder)
        shop_.prepare(table)
        return shop_.table(table).drop(*AUDIT)

    query(run, query_name)


MODELS = {
    "stg_customers_latest": "stg_customers",
    "stg_products_category": "stg_products",
    "stg_orders_flags": "stg_orders",
    "stg_items_flags": "stg_order_items",
    "stg_payments_clean": "stg_payment_transactions",
    "stg_campaign_clean": "stg_campaign_performance",
    "stg_sends_clean": "stg_email_sends",
    "stg_inventory_cast": "stg_inventory_snapshot",
    "stg_po_cast": "stg_purchase_orders",
    "dim_customers": "dim_customers",
    "dim_products": "dim_products",
    "fact_orders": "fact_orders",
    "fact_order_items": "fact_order_items",
    "fact_payments": "fact_payments",
    "fact_inventory": "fact_inventory_daily",
    "fact_campaign": "fact_campaign_performance",
    "fact_email": "fact_email_engagement",
    "fact_purchase_orders": "fact_purchase_orders",
    "customer_lifetime_value": "metric_customer_lifetime_value",
    "conversion_rate": "metric_order_conversion_rate",
    "campaign_revenue": "metric_revenue_by_campaign",
    "inventory_turnover": "metric_inventory_turnover",
}
for _name, _table in MODELS.items():
    _model(_name, _table)


# sources and sinks


@query
def bronze_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Land every day of the e-mail sends, then read one day back."""
    root, entity = _land_sends(spark, folder)
    day = landing.read_partition(spark, root, entity, "2024-01-15")
    return day.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


def _land_sends(spark: SparkSession, folder: str):
    root, entity = Scratch(spark).path, BY_TABLE["email_sends"]
    sends = role(spark, folder, "email_sends")
    landing.land_days(sends, root, entity, F.col("send_date"))
    return root, entity


@query
def landing_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Land the sends twice: the second load replaces the first, day by day."""
    root, entity = _land_sends(spark, folder)
    sends = role(spark, folder, "email_sends")
    landing.land_days(sends, root, entity, F.col("send_date"))
    return (
        landing.read_landed(spark, root, entity)
        .groupBy("dt")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("customer_id").alias("customer_sum"),
            F.count_if("open_flag").alias("opened"),
        )
    )


def _wall_clock(instant: Column) -> Column:
    """An instant as UTC wall-clock time, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def _sends_as_csv(texts: DataFrame) -> str:
    path = f"{Scratch(texts.sparkSession).path}/sends.csv"
    plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    texts.write.options(header=True, escape='"', **plain).csv(path)
    return path


@query
def ingest_log(spark: SparkSession, folder: str) -> DataFrame:
    """The load log of two extracts, one of which is missing, and the rows landed."""
    sends = role(spark, folder, "email_sends").withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))
    path, root = _sends_as_csv(sends), Scratch(spark).path
    files = {"marketing/email_sends": path, "inventory/purchase_orders": f"{root}/nowhere.csv"}
    log = loads.ingest(spark, files, root, "2024-01-15", run_id="r1")
    landed = landing.read_landed(spark, root, BY_TABLE["email_sends"]).groupBy("dt").agg(F.count(F.lit(1)).alias("landed"))
    return log.join(landed, F.col("raw_path").endswith(F.concat(F.lit("dt="), F.col("dt"))), "left").select(
        "run_id",
        "source",
        "entity",
        "status",
        "rows_ingested",
        F.coalesce("landed", F.lit(0)).alias("landed"),
        "schema_hash",
        "schema_columns",
        (F.col("error_message") != "").alias("has_error"),
        (F.col("completed_at") >= F.col("started_at")).alias("timed"),
    )


@query
def csv_extract_typed(spark: SparkSession, folder: str) -> DataFrame:
    """The sends written as CSV text and read as an extract is.

    Every fifth customer's day is an instant of 23:30 five hours west, so the next day in
    UTC; every seventh has no campaign name; one column is not registered.
    """
    sends = role(spark, folder, "email_sends")
    late = F.concat(F.date_format("send_date", "yyyy-MM-dd"), F.lit("T23:30:00-05:00"))
    texts = (
        sends.withColumn("send_date", F.when(F.col("customer_id") % 5 == 0, late).otherwise(F.col("send_date").cast("string")))
        .withColumn("campaign_name", F.when(F.col("customer_id") % 7 == 0, F.lit("N/A")).otherwise(F.col("campaign_name")))
        .withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))
        .withColumn("batch note", F.concat(F.lit('said "'), F.col("campaign_id"), F.lit('", twice')))
    )
    read = read_entity(spark, BY_TABLE["email_sends"], _sends_as_csv(texts))
    return read.withColumn("loaded_at", _wall_clock(F.col("loaded_at"))).withColumnRenamed("batch note", "batch_note")


def _payment_texts(spark: SparkSession, folder: str, more: bool) -> str:
    """Payments as JSON text, one object per line; with ``more`` some have a key of their own."""
    payments = role(spark, folder, "payment_transactions").withColumn(
        "provider_created_at", F.date_format("provider_created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    if more:
        payments = payments.withColumn("voucher", F.when(F.col("order_id") % 100 == 1, F.concat(F.lit("v"), "order_id")))
    path = f"{Scratch(spark).path}/payments.json"
    payments.write.json(path)
    return path


@query
def json_extract_typed(spark: SparkSession, folder: str) -> DataFrame:
    """The payments written as JSON text, some with a new key, and read as an extract is."""
    path = _payment_texts(spark, folder, more=True)
    read = read_entity(spark, BY_TABLE["payment_transactions"], path, json_lines=True)
    return read.withColumn("provider_created_at", _wall_clock(F.col("provider_created_at")))


#: So many payments a provider's page has at most, about five MB.
ROWS_OF_A_PAGE = 1 << 14


@query
def json_array_typed(spark: SparkSession, folder: str) -> DataFrame:
    """The payments as files that each hold one JSON array, as a provider's page dumps do."""
    payments = role(spark, folder, "payment_transactions").withColumn(
        "provider_created_at", F.date_format("provider_created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    # A page is one array, so it has to fit a row: their number grows with the payments, not their size.
    page = F.floor(F.col(ROW_TAG) / ROWS_OF_A_PAGE)
    pages = with_row_tag(payments).groupBy(page.alias("page")).agg(F.collect_list(F.struct(*payments.columns)).alias("rows"))
    path = f"{Scratch(spark).path}/pages"
    pages.select("page", F.to_json("rows").alias("value")).write.partitionBy("page").text(path)
    read = read_entity(spark, BY_TABLE["payment_transactions"], f"{path}/page=*")
    return read.withColumn("provider_created_at", _wall_clock(F.col("provider_created_at")))


def _csv_extract(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A role written as CSV text and read as an extract is; instants in whole seconds."""
    rows, entity = role(spark, folder, table), BY_TABLE[table]
    instants = [f.name for f in entity.schema if f.dataType.typeName() == "timestamp"]
    texts = rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in instants})
    path = f"{Scratch(spark).path}/{table}.csv"
    texts.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_entity(spark, entity, path).withColumns({c: _wall_clock(F.col(c)) for c in instants})


@query
def csv_orders_typed(spark: SparkSession, folder: str) -> DataFrame:
    return _csv_extract(spark, folder, "orders")


@query
def csv_inventory_typed(spark: SparkSession, folder: str) -> DataFrame:
    return _csv_extract(spark, folder, "inventory_snapshot")


@query
def bronze_unknown_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of sends and of payments, the second with a column of its own, read back and stored in bronze.

    Each day is listed with its rows and with what the column holds there.
    """
    scratch, parts = Scratch(spark), []
    sends = role(spark, folder, "email_sends").withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))
    noted = sends.withColumn("batch note", F.concat(F.lit("n"), F.col("customer_id") % 10))
    extracts = {
        "2024-01-01": (_sends_as_csv(sends), _payment_texts(spark, folder, more=False)),
        "2024-01-02": (_sends_as_csv(noted), _payment_texts(spark, folder, more=True)),
    }
    for dt, (csv, json) in extracts.items():
        files = {"marketing/email_sends": csv, "payments/transactions": json}
        log = loads.ingest(spark, files, scratch.path, dt, run_id=dt, json_lines=True)
        loads.append_log(log, scratch.path)
    log = spark.read.parquet(f"{scratch.path}/ingestion_log")
    for table, column in (("email_sends", "batch note"), ("payment_transactions", "voucher")):
        entity = BY_TABLE[table]
        others = loads.other_columns(log, entity)
        found = landing.read_landed(spark, scratch.path, entity, others=others)
        bronze = scratch.stage(landing.read_partition(spark, scratch.path, entity, "2024-01-02"), table)
        for layer, rows in (("landed", found), ("bronze", bronze.withColumn("dt", F.lit("2024-01-02")))):
            counted = rows.groupBy("dt").agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count(f"`{column}`").alias("filled"),
                F.count_distinct(f"`{column}`").alias("different"),
                F.max(f"`{column}`").alias("greatest"),
            )
            parts.append(counted.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query
def stored_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the catalogue tables after a store, and a further one whose last model fails."""
    place = Scratch(spark).path
    prefix = f"s{place[-12:]}_"
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE {prefix}{layer} LOCATION '{place}/{layer}'")
    shop(spark, folder).store(prefix=prefix)
    broken = shop(spark, folder)
    found, last = broken.table, LAYERS["gold"][-1]

    def table(name: str) -> DataFrame:
        model = found(name)
        if name != last:
            return model
        # The last model fails while it is written, by a row behind all of its own; the tables before it are written already.
        wrong = [F.raise_error("no such model"), *[F.lit(None)] * (len(model.columns) - 1)]
        return model.unionByName(spark.range(1).select(*[c.alias(n) for c, n in zip(wrong, model.columns)]))

    broken.table = table
    try:
        broken.store(prefix=prefix)
    except Exception as problem:  # noqa: BLE001 - Spark's errors have no common type
        if "no such model" not in str(problem):
            raise
    else:
        raise AssertionError("the broken store was published")
    tables = {layer: {n: spark.table(f"{prefix}{layer}.{n}") for n in names} for layer, names in LAYERS.items()}
    return table_stats(tables)


@query
def json_extract_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of two loads of payments, and that a new key is a drift."""
    prints = []
    for dt, more in (("2024-01-01", False), ("2024-01-02", True)):
        path = _payment_texts(spark, folder, more)
        texts = read_text(spark, BY_TABLE["payment_transactions"], path, json_lines=True)
        found = loads.entity_fingerprint(texts, "payments/transactions")
        counted = texts.agg(F.count(F.lit(1)).alias("row_count"))
        # One row each.
        prints.append(found.join(F.broadcast(counted)).select(F.lit("payments").alias("entity"), F.lit(dt).alias("dt"), "*"))
    compared = profile.drift(prints[0].unionByName(prints[1]))
    return compared.select("dt", "schema_columns", "row_count", "drifted")


@query
def landing_empty_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts per extract; one without rows may not be landed."""
    events = role(spark, folder, "email_sends")
    return loads.entity_counts(
        {
            "email_sends": events,
            "late_sends": events.where(F.col("send_date") > F.to_date(F.lit("2100-01-01"))),
            "customers": role(spark, folder, "customers"),
        }
    )


@query
def load_request_check(spark: SparkSession, folder: str) -> DataFrame:
    requests = role(spark, folder, "load_requests")
    return loads.rejected_requests(requests, loads.known_entities(spark))


@query
def ingestion_log(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per registered entity with its source, as the load log counts them."""
    tables = {e.table: role(spark, folder, e.table) for e in ENTITIES}
    counts = loads.entity_counts(tables).withColumnRenamed("entity", "table_name")
    named = counts.join(F.broadcast(loads.known_entities(spark)), "table_name")
    status = F.when(F.col("admissible"), "success").otherwise("failed")
    return named.select("source", "entity", status.alias("status"), "rows_ingested")


def _event_profile(spark: SparkSession, folder: str) -> DataFrame:
    texts = role(spark, folder, "event_texts")
    return profile.with_dtype(profile.column_profile(texts, by=["dt"]), dates=["ts"])


@query
def schema_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _event_profile(spark, folder)


@query
def schema_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of each input table, its columns read as text."""
    parts = []
    for name in ("customer", "part", "orders", "lineitem", "events"):
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        dates = [f.name for f in table.schema if f.dataType.typeName().startswith("timestamp")]
        typed = profile.with_dtype(profile.column_profile(table), dates=dates)
        parts.append(profile.fingerprint(typed).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    prints = profile.fingerprint(_event_profile(spark, folder), by=["dt"])
    return profile.drift(prints.withColumn("entity", F.lit("events")))


@query
def seed_category(spark: SparkSession, folder: str) -> DataFrame:
    """Products per seeded category."""
    shop_ = shop(spark, folder)
    used = shop_.stg_products.groupBy("category_raw").agg(F.count(F.lit(1)).alias("n"))
    return shop_.seed_category_mapping.join(used, "category_raw", "left").select(
        "category_raw", "category_standardized", F.coalesce("n", F.lit(0)).alias("products")
    )


@query
def seed_fx(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per seeded currency."""
    shop_ = shop(spark, folder)
    used = shop_.stg_orders.groupBy("currency").agg(F.count(F.lit(1)).alias("n"))
    return shop_.seed_exchange_rates.join(used, "currency", "left").select(
        "currency", "rate_to_usd", F.coalesce("n", F.lit(0)).alias("orders")
    )


@named("table_stats")
def table_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table of the three layers."""
    shop_ = shop(spark, folder)
    shop_.prepare(*KEYED)
    return table_stats({layer: {n: shop_.table(n) for n in names} for layer, names in LAYERS.items()})


@named("missing_tables")
def missing_gold_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Gold tables that are absent when only dimensions and orders were built, or are empty."""
    shop_ = shop(spark, folder)
    built = ("dim_date", "dim_customers", "dim_products", "fact_orders")
    stats = table_stats({"gold": {name: shop_.table(name) for name in built}})
    return missing_tables(spark, stats.where("row_count > 0"), GOLD)


# dimensions and operators


@query
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar from the first order to the last shipment."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    ends = (
        orders.select(F.col("o_orderdate").cast("date").alias("day"))
        .unionByName(items.select(F.col("l_shipdate").cast("date").alias("day")))
        .agg(F.min("day").alias("first"), F.max("day").alias("last"))
    )
    days = ends.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return dims.dim_date(days)


@query
def campaign_attribution(spark: SparkSession, folder: str) -> DataFrame:
    shop_ = shop(spark, folder)
    shop_.prepare("fact_email_engagement", "fact_orders")
    return attributed_revenue(shop_.fact_email_engagement, shop_.fact_orders, shop_.dim_date)


@query
def attribution_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Every send with every order that its customer placed within a week, row by row."""
    shop_ = shop(spark, folder)
    shop_.prepare("fact_email_engagement", "fact_orders")
    sends = with_day(
        shop_.fact_email_engagement.select("email_sk", "customer_sk", "send_date_key"), shop_.dim_date, "send_date_key", "send_day"
    )
    orders = shop_.fact_orders.where(~F.col("is_cancelled"))
    orders = with_day(
        orders.select("order_sk", F.col("customer_sk").alias("buyer_sk"), "order_date_key"), shop_.dim_date, "order_date_key", "order_day"
    )
    pairs = within_days(sends, orders, key=("customer_sk", "buyer_sk"), day=("send_day", "order_day"), days=7)
    return pairs.select("email_sk", "order_sk", F.datediff("order_day", "send_day").alias("days"))


@query
def dense_key_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Dense key over every column: line numbers repeat within an order."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber"]
    order += [c for c in items.columns if c not in order]
    return dense_key(items, order, "line_sk", Scratch(spark), ID_TYPE)


@query
def dense_key_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Dense key whose first column has one value in a third of the rows; the next ones are text and dates."""
    items = with_row_tag(spark.read.parquet(f"{folder}/lineitem.parquet"))
    rows = items.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")).alias("group_key"),
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("ship_day"),
        "l_orderkey",
        "l_linenumber",
        ROW_TAG,
    )
    order = ["group_key", "l_returnflag", "ship_day", "l_orderkey", "l_linenumber"]
    return dense_key(rows, order, "row_sk", Scratch(spark), ID_TYPE)


# quality

_AMOUNTS = (
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "fact_inventory_daily",
    "fact_purchase_orders",
)


def _checks(spark: SparkSession, folder: str, *tables: str) -> Checks:
    """Checks over the shop; ``tables`` are the keyed models they read, all by default."""
    shop_ = shop(spark, folder)
    shop_.prepare(*(tables or KEYED))
    return Checks(spark, lambda name: shop_.table(name.split(".")[1]), id_type=ID_TYPE)


@query
def dq_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder).nulls()


def _schemas_and_rows(checks: Checks) -> DataFrame:
    """Schema checks with the rows of the tables they are about."""
    tables = {name: checks.table(name) for name in specs.SCHEMAS}
    rows = table_stats({"gold": tables}).where("table_name IS NOT NULL").select("table_name", "row_count")
    return checks.schemas().join(rows, "table_name")


@query
def dq_schema(spark: SparkSession, folder: str) -> DataFrame:
    return _schemas_and_rows(_checks(spark, folder))


@query
def dq_schema_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Schema checks of tables of which one lacks a column and one has two columns of other types."""
    checks = _checks(spark, folder)

    def changed(name: str) -> DataFrame:
        table = checks.table(name)
        if name == "gold.dim_products":
            return table.drop("sku")
        if name == "gold.fact_orders":
            return table.withColumns({c: F.col(c).cast(t) for c, t in RETYPED.items()})
        return table

    return _schemas_and_rows(Checks(spark, changed, id_type=ID_TYPE))


@query
def dq_references_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """References into parents that lack every tenth key."""
    checks = _checks(spark, folder)

    def parents(name: str) -> DataFrame:
        return checks.table(name).where(KEPT_PARENTS.get(name.split(".")[1], "true"))

    return Checks(spark, checks.table, id_type=ID_TYPE, parents=parents).references()


@query
def dq_amount_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Arithmetic and sign checks of amounts whose sign is turned on every seventh row."""
    checks = _checks(spark, folder, *_AMOUNTS)

    def faulty(name: str) -> DataFrame:
        table = name.split(".")[1]
        columns = TURNED_AMOUNTS[table][1] if table in TURNED_AMOUNTS else ()
        found = checks.table(name)
        return found.withColumns({c: F.expr(turned(table, c)).cast(found.schema[c].dataType) for c in columns})

    return Checks(spark, faulty, id_type=ID_TYPE).arithmetic()


@query
def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder).duplicates()


@query
def dq_duplicates_planted(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicate checks over tables in which every fortieth row is repeated and some keys are missing."""
    checks = _checks(spark, folder)

    def repeated(name: str) -> DataFrame:
        table = checks.table(name)
        if name not in specs.UNIQUE:
            return table
        key, number = repeats(name)
        lost = F.when(F.expr(f"{number} % 40 <> 2"), F.col(key)).alias(key)
        again = table.where(f"{number} % 40 = 1")
        return table.select(*[lost if c == key else F.col(c) for c in table.columns]).unionByName(again)

    return Checks(spark, repeated, id_type=ID_TYPE).duplicates()


@query
def dq_references(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder).references()


@query
def dq_currency(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder, "fact_orders", "fact_payments").currency()


@query
def dq_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder, *_AMOUNTS).arithmetic()


@query
def dq_nonnegative(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder, *_AMOUNTS).non_negative()


@query
def report_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two reports written and read back: the newer one's checks with its stored totals."""
    checks, target = _checks(spark, folder, *_AMOUNTS).arithmetic(), Scratch(spark).path
    append_report(checks.where("passed"), target, "r1")
    append_report(checks, target, "r2")
    rows = spark.read.schema(checks.schema.add("run_id", "string")).json(f"{target}/checks")
    totals = spark.read.option("header", True).csv(f"{target}/history").drop("run_ts")
    return rows.where("run_id = 'r2'").join(totals.withColumnsRenamed({"passed": "n_passed", "failed": "n_failed"}), "run_id")


@query
def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    """All checks, totalled per category."""
    return summary(_checks(spark, folder).all(), "category")


# histories


@query
def run_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.run_history(role(spark, folder, "tasks"))


@query
def run_success_rate(spark: SparkSession, folder: str) -> DataFrame:
    return history.run_success_rate(history.run_history(role(spark, folder, "tasks")))


@query
def task_duration(spark: SparkSession, folder: str) -> DataFrame:
    return history.task_durations(role(spark, folder, "tasks"))


@query
def task_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.task_history(role(spark, folder, "tasks"))


@query
def failure_log(spark: SparkSession, folder: str) -> DataFrame:
    return history.failure_log(role(spark, folder, "tasks"))


@query
def volume_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return history.volume_by_source(role(spark, folder, "load_log"))


@query
def dq_trend(spark: SparkSession, folder: str) -> DataFrame:
    reports = summary(role(spark, folder, "check_reports"), "run_id")
    return history.dq_trend(reports)


@query
def newest_report_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of many runs, stored by run: the failures of the newest, of which alone a partition is read."""
    reports, place = role(spark, folder, "check_reports"), Scratch(spark).path
    reports.repartition("run_id").write.partitionBy("run_id").json(f"{place}/checks")
    newest = newest_report(spark, place, reports.drop("run_id").schema)
    return newest.where(~F.col("passed"))


@named("latest_failures")
def latest_report_failures(spark: SparkSession, folder: str) -> DataFrame:
    return latest_failures(role(spark, folder, "check_reports"))
