"""Registry of source entities: where each comes from, its format and its types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "text": T.StringType(),
    "money": T.DecimalType(18, 2),
    "flag": T.BooleanType(),
    "date": T.DateType(),
    "instant": T.TimestampType(),
}


Columns = tuple[tuple[str, str], ...]


def _schema(columns: Columns) -> T.StructType:
    """Build a schema from (column, kind) pairs in file order."""
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns])


@dataclass(frozen=True)
class Entity:
    """One extract of a source system."""

    source: str
    name: str
    table: str  # name of the bronze table
    file_format: str  # "csv" (with header) or "json"
    schema: T.StructType
    parsed_dates: tuple[str, ...] = ()  # columns read as dates or instants

    @property
    def key(self) -> str:
        return f"{self.source}/{self.name}"


def _entity(
    source: str, name: str, columns: Columns, table: str | None = None, file_format: str = "csv"
):
    schema = _schema(columns)
    parsed = tuple(
        f.name for f in schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType))
    )
    return Entity(source, name, table or name, file_format, schema, parsed)


# The extracts and their columns.
ENTITIES: tuple[Entity, ...] = (
    _entity(
        "postgres",
        "orders",
        (
            ("order_id", "long"), ("customer_id", "long"), ("order_date", "instant"),
            ("order_status", "text"), ("currency", "text"), ("subtotal_amount", "money"),
            ("discount_amount", "money"), ("shipping_amount", "money"), ("tax_amount", "money"),
            ("total_amount", "money"), ("payment_status", "text"),
            ("shipping_address_id", "long"), ("billing_address_id", "long"),
            ("updated_at", "instant"),
        ),
    ),
    _entity(
        "postgres",
        "order_items",
        (
            ("order_item_id", "long"), ("order_id", "long"), ("product_id", "long"),
            ("sku", "text"), ("product_name", "text"), ("quantity", "long"),
            ("unit_price", "money"), ("discount_amount", "money"), ("line_total", "money"),
        ),
    ),
    _entity(
        "postgres",
        "customers",
        (
            ("customer_id", "long"), ("email", "text"), ("first_name", "text"),
            ("last_name", "text"), ("phone", "text"), ("created_at", "instant"),
            ("country_code", "text"), ("status", "text"), ("marketing_opt_in", "flag"),
        ),
    ),
    _entity(
        "postgres",
        "products",
        (
            ("product_id", "long"), ("sku", "text"), ("product_name", "text"),
            ("category", "text"), ("brand", "text"), ("unit_cost", "money"),
            ("list_price", "money"), ("is_active", "flag"), ("created_at", "instant"),
        ),
    ),
    _entity(
        "payments",
        "transactions",
        (
            ("transaction_id", "text"), ("order_id", "long"), ("customer_id", "long"),
            ("payment_method", "text"), ("transaction_type", "text"), ("status", "text"),
            ("currency", "text"), ("gross_amount", "money"), ("fee_amount", "money"),
            ("net_amount", "money"), ("provider_created_at", "instant"), ("card_brand", "text"),
            ("card_country", "text"), ("failure_reason", "text"), ("refund_flag", "flag"),
        ),
        table="payment_transactions",
        file_format="json",
    ),
    _entity(
        "marketing",
        "campaign_performance",
        (
            ("campaign_date", "date"), ("platform", "text"), ("campaign_id", "text"),
            ("campaign_name", "text"), ("channel", "text"), ("impressions", "long"),
            ("clicks", "long"), ("spend", "money"), ("conversions", "long"),
            ("reported_revenue", "money"), ("country_code", "text"), ("device_type", "text"),
            ("load_filename", "text"), ("loaded_at", "instant"),
        ),
    ),
    _entity(
        "marketing",
        "email_sends",
        (
            ("send_date", "date"), ("campaign_id", "text"), ("campaign_name", "text"),
            ("recipient_email", "text"), ("customer_id", "long"), ("delivery_status", "text"),
            ("open_flag", "flag"), ("click_flag", "flag"), ("unsubscribe_flag", "flag"),
            ("load_filename", "text"), ("loaded_at", "instant"),
        ),
    ),
    _entity(
        "inventory",
        "inventory_snapshot",
        (
            ("snapshot_date", "date"), ("warehouse_id", "long"), ("sku", "text"),
            ("product_id", "long"), ("on_hand_qty", "long"), ("reserved_qty", "long"),
            ("available_qty", "long"), ("reorder_point", "long"), ("unit_cost", "money"),
        ),
    ),
    _entity(
        "inventory",
        "purchase_orders",
        (
            ("po_id", "long"), ("supplier_id", "long"), ("sku", "text"), ("ordered_qty", "long"),
            ("received_qty", "long"), ("unit_cost", "money"), ("po_status", "text"),
            ("created_at", "instant"), ("expected_delivery_date", "date"),
        ),
    ),
)

BY_KEY = {entity.key: entity for entity in ENTITIES}
BY_TABLE = {entity.table: entity for entity in ENTITIES}
