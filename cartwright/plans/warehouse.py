"""The whole warehouse: model dependencies, stored tables and their statistics."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.plans import dims, facts, metrics, silver
from cartwright.plans.publish import CODEC, Publication
from cartwright.sources import landing, seeds
from cartwright.sources.entities import ENTITIES
from cartwright.sources.scratch import Scratch

# The tables of each layer.
BRONZE = tuple(entity.table for entity in ENTITIES)
SILVER = (
    "seed_category_mapping",
    "seed_exchange_rates",
    *(f"stg_{table}" for table in BRONZE),
)
GOLD = (
    "dim_date",
    "dim_customers",
    "dim_products",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "fact_inventory_daily",
    "fact_campaign_performance",
    "fact_email_engagement",
    "fact_purchase_orders",
    "metric_customer_lifetime_value",
    "metric_order_conversion_rate",
    "metric_revenue_by_campaign",
    "metric_inventory_turnover",
)
LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}

# Keyed models by level: a model reads keyed models of earlier levels only.
KEY_LEVELS = (
    ("dim_customers", "dim_products", "fact_campaign_performance"),
    ("fact_orders", "fact_inventory_daily", "fact_email_engagement", "fact_purchase_orders"),
    ("fact_order_items", "fact_payments"),
)
KEY_NEEDS = {
    "fact_orders": ("dim_customers",),
    "fact_email_engagement": ("dim_customers",),
    "fact_inventory_daily": ("dim_products",),
    "fact_purchase_orders": ("dim_products",),
    "fact_order_items": ("fact_orders", "dim_products"),
    "fact_payments": ("fact_orders", "dim_customers"),
}
METRIC_NEEDS = {
    "metric_customer_lifetime_value": ("dim_customers", "fact_orders"),
    "metric_order_conversion_rate": ("fact_orders",),
    "metric_revenue_by_campaign": (
        "fact_email_engagement",
        "fact_campaign_performance",
        "fact_orders",
    ),
    "metric_inventory_turnover": (
        "fact_order_items",
        "fact_inventory_daily",
        "fact_purchase_orders",
    ),
}
KEYED = tuple(name for level in KEY_LEVELS for name in level)


HASHED_SHARE = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


@contextmanager
def hashed_lookups(spark: SparkSession) -> Iterator[None]:
    """Joins that shuffle hash a side whose tasks' shares are all found small, as large as a task is advised to be at most.

    The wide side is then not sorted. Larger shares are sorted as before, and a session's own setting stands.
    """
    if spark.conf.get(HASHED_SHARE) not in ("0", "0b"):
        yield
        return
    spark.conf.set(HASHED_SHARE, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.unset(HASHED_SHARE)


BUILDING = {
    # Shuffle files go as soon as the write or count that made them has ended. Otherwise they stay until the driver's
    # garbage collection finds them, so that a build needs disk for all its shuffles at once.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Copies of dimensions take 2.4 times less than with snappy; their files should not pass for tables so small as to be broadcast.
    "spark.sql.sources.fileCompressionFactor": "2.4",
}


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """The settings of ``BUILDING``; a session's own ones stand."""
    ours = {key: value for key, value in BUILDING.items() if spark.conf.get(key, None) is None}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in ours:
            spark.conf.unset(key)


class Warehouse:
    """Every model as a DataFrame attribute, built on first use.

    ``tables`` are the bronze tables by name: stored tables or row-wise views of them. Staging
    tables and metrics are lazy. Touching a dimension or a fact runs jobs: it is written once to
    scratch space while its keys are assigned, and everything that reads it reads that copy.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: dict[str, DataFrame],
        as_of: date,
        loaded_at: datetime | None = None,
        first_day: date = dims.FIRST_DAY,
        last_day: date = dims.LAST_DAY,
        id_type: str = "int",
        scratch: Scratch | None = None,
    ):
        self.spark, self.tables = spark, tables
        self.as_of, self.loaded_at = as_of, loaded_at
        self.first_day, self.last_day = first_day, last_day
        self.id_type = id_type
        self.scratch = scratch or Scratch(spark, codec=CODEC)
        self._stored: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A model by table name; a stored copy takes the model's place."""
        if name in self._stored:
            return self._stored[name]
        return self.tables[name] if name in self.tables else getattr(self, name)

    # silver

    @cached_property
    def seed_category_mapping(self) -> DataFrame:
        return seeds.seed_category_mapping(self.spark)

    @cached_property
    def seed_exchange_rates(self) -> DataFrame:
        return seeds.seed_exchange_rates(self.spark)

    def _stage(self, name: str, **options) -> DataFrame:
        return getattr(silver, f"stg_{name}")(self.table(name), id_type=self.id_type, **options)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._stage("customers")

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._stage("products", category_mapping=self.seed_category_mapping)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._stage("orders")

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self._stage("order_items")

    @cached_property
    def stg_payment_transactions(self) -> DataFrame:
        return self._stage("payment_transactions")

    @cached_property
    def stg_campaign_performance(self) -> DataFrame:
        return self._stage("campaign_performance")

    @cached_property
    def stg_email_sends(self) -> DataFrame:
        return self._stage("email_sends")

    @cached_property
    def stg_inventory_snapshot(self) -> DataFrame:
        return self._stage("inventory_snapshot")

    @cached_property
    def stg_purchase_orders(self) -> DataFrame:
        return self._stage("purchase_orders")

    # gold

    def _keyed(self, model, *names: str, **options) -> DataFrame:
        inputs = [self.table(name) for name in names]
        return model(
            *inputs,
            scratch=self.scratch,
            key_type=self.id_type,
            loaded_at=self.loaded_at,
            **options,
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(dims.calendar_days(self.spark, self.first_day, self.last_day))

    @cached_property
    def dim_customers(self) -> DataFrame:
        # Its key reads the staging rows several times; they need a window and a join, so they are written once.
        customers, staged = self.table("stg_customers"), "stg_customers" not in self._stored
        if staged:
            customers = self.scratch.stage(customers, "stg_customers")
        keyed = dims.dim_customers(customers, self.scratch, self.id_type, self.loaded_at)
        if staged:
            self.scratch.drop(customers)
        return keyed

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._keyed(dims.dim_products, "stg_products")

    @cached_property
    def fact_orders(self) -> DataFrame:
        return self._keyed(
            facts.fact_orders, "stg_orders", "dim_customers", "dim_date", "seed_exchange_rates"
        )

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return self._keyed(
            facts.fact_order_items, "stg_order_items", "fact_orders", "dim_products"
        )

    @cached_property
    def fact_payments(self) -> DataFrame:
        return self._keyed(
            facts.fact_payments,
            "stg_payment_transactions",
            "fact_orders",
            "dim_customers",
            "dim_date",
            "seed_exchange_rates",
        )

    @cached_property
    def fact_inventory_daily(self) -> DataFrame:
        return self._keyed(
            facts.fact_inventory_daily, "stg_inventory_snapshot", "dim_products", "dim_date"
        )

    @cached_property
    def fact_campaign_performance(self) -> DataFrame:
        return self._keyed(
            facts.fact_campaign_performance, "stg_campaign_performance", "dim_date"
        )

    @cached_property
    def fact_email_engagement(self) -> DataFrame:
        return self._keyed(
            facts.fact_email_engagement, "stg_email_sends", "dim_customers", "dim_date"
        )

    @cached_property
    def fact_purchase_orders(self) -> DataFrame:
        return self._keyed(
            facts.fact_purchase_orders,
            "stg_purchase_orders",
            "dim_products",
            "dim_date",
            as_of=self.as_of,
        )

    @cached_property
    def metric_customer_lifetime_value(self) -> DataFrame:
        return metrics.customer_lifetime_value(
            self.table("dim_customers"),
            self.table("fact_orders"),
            self.table("dim_date"),
            self.as_of,
            self.loaded_at,
        )

    @cached_property
    def metric_order_conversion_rate(self) -> DataFrame:
        return metrics.order_conversion_rate(
            self.table("fact_orders"), self.table("dim_date"), self.loaded_at
        )

    @cached_property
    def metric_revenue_by_campaign(self) -> DataFrame:
        return metrics.revenue_by_campaign(
            self.table("fact_email_engagement"),
            self.table("fact_campaign_performance"),
            self.table("fact_orders"),
            self.table("dim_date"),
            self.loaded_at,
        )

    @cached_property
    def metric_inventory_turnover(self) -> DataFrame:
        return metrics.inventory_turnover(
            self.table("fact_order_items"),
            self.table("fact_orders"),
            self.table("dim_products"),
            self.table("fact_inventory_daily"),
            self.table("fact_purchase_orders"),
            self.loaded_at,
        )

    def prepare(self, *names: str) -> None:
        """Assign the keys of the given models and of what they build on.

        Models of one level do not read each other, so their jobs run side by side and
        fill the cluster.
        """
        wanted = set(names)
        for name in names:
            wanted.update(METRIC_NEEDS.get(name, ()))
        for level in reversed(KEY_LEVELS):
            for name in wanted.intersection(level):
                wanted.update(KEY_NEEDS.get(name, ()))
        for level in KEY_LEVELS:
            self._side_by_side(self.table, [name for name in level if name in wanted])

    def _side_by_side(self, action, names: list[str]) -> None:
        if not names:
            return
        for name in ("seed_category_mapping", "seed_exchange_rates", "dim_date"):
            self.table(name)  # shared inputs: plans only, no job
        with hashed_lookups(self.spark), lean_disk(self.spark), ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(action), names))

    def store(self, layers: tuple[str, ...] = tuple(LAYERS), prefix: str = "") -> dict[str, DataFrame]:
        """Replace the catalogue tables of the given layers, all of them or none.

        Tables are written beside the published ones in dependency order, later models reading the new
        copies, and are published together at the end (``publish``). If a model fails, what was
        written is removed and readers go on with what there was. ``prefix`` is put before the layers' database names.
        The copy that a keyed model is made from is removed once the model is stored, what else was staged at the end.
        """
        publication, before = Publication(self.spark), dict(self._stored)
        # Metrics that were asked for before read the copies.
        copies_read = bool(METRIC_NEEDS.keys() & self.__dict__.keys())
        try:
            for layer in layers:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")

                def save(name: str, layer: str = layer) -> None:
                    model = self.table(name)
                    self._stored[name] = publication.write(model, f"{prefix}{layer}.{name}")
                    if name in KEYED and not copies_read:
                        self.scratch.drop_named(model.columns[0])

                names = LAYERS[layer]
                levels = [[n for n in level if n in names] for level in KEY_LEVELS]
                keyed = {n for level in levels for n in level}
                metrics_ = [n for n in names if n.startswith("metric_")]
                plain = [n for n in names if n not in keyed and n not in metrics_]
                for level in (plain, *levels, metrics_):
                    self._side_by_side(save, level)
            publication.publish()
        except BaseException:
            self._stored = before
            publication.discard()
            raise
        finally:
            self.scratch.release()
        return dict(self._stored)


def open_landing(
    spark: SparkSession, landing_root: str, dt: str, as_of: date, **options
) -> Warehouse:
    """Warehouse over one landed day."""
    return Warehouse(spark, landing.bronze(spark, landing_root, ENTITIES, dt), as_of, **options)


def table_stats(tables: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Row count per table, plus a total, in one job. ``tables``: layer -> name -> table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, named in tables.items()
        for name, df in named.items()
    ]
    each = counts[0]
    for other in counts[1:]:
        each = each.unionByName(other)
    return (
        each.rollup("layer", "table_name")
        .agg(F.sum("row_count").alias("row_count"))
        # A roll-up row has NULL for what was added up.
        .select("layer", "table_name", "row_count")
    )


def missing_tables(spark: SparkSession, actual: DataFrame, expected=GOLD) -> DataFrame:
    """Expected table names absent from ``actual.table_name``."""
    rows = ", ".join(f"('{name}')" for name in expected)
    wanted = spark.sql(f"SELECT * FROM VALUES {rows} AS t(table_name)")
    return wanted.join(actual.where("table_name IS NOT NULL"), "table_name", "left_anti")
