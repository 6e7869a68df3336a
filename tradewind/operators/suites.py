"""The declared checks: five suites over raw data, column tests over the models, freshness limits."""

from __future__ import annotations

from datetime import datetime, timezone

from tradewind import schemas
from tradewind.functions.text import EMAIL_PATTERN, UUID_PATTERN
from tradewind.operators.quality import (
    Check, between, column_count, column_exists, in_set, matches, not_null, references, row_count, unique,
)

PLAUSIBLE_FROM = datetime(2020, 1, 1, tzinfo=timezone.utc)
PLAUSIBLE_TO = datetime(2030, 12, 31, 23, 59, 59, tzinfo=timezone.utc)


def _shape(schema) -> list[Check]:
    return [*map(column_exists, schema.names), column_count(len(schema.names))]


def _not_null(columns: str, mostly: float = 1.0) -> list[Check]:
    return [not_null(name, mostly) for name in columns.split()]


def _plausible(*columns: str) -> list[Check]:
    return [between(name, PLAUSIBLE_FROM, PLAUSIBLE_TO) for name in columns]


def customers() -> list[Check]:
    return [
        *_shape(schemas.CUSTOMERS),
        *_not_null("customer_id email first_name last_name created_at updated_at"),
        unique("customer_id"),
        unique("email"),
        matches("email", EMAIL_PATTERN, mostly=0.99),
        row_count(800, 50_000),
        *_plausible("created_at", "updated_at"),
    ]


def orders_history() -> list[Check]:
    return [
        *_shape(schemas.ORDERS_HISTORY),
        *_not_null("order_id customer_id order_status total_amount payment_method order_date created_at"),
        unique("order_id"),
        in_set("order_status", schemas.ORDER_STATUSES),
        in_set("payment_method", schemas.PAYMENT_METHODS),
        between("total_amount", 0.01, 100_000),
        row_count(4_000, 500_000),
        *_plausible("order_date", "created_at"),
        matches("order_id", UUID_PATTERN),
        matches("customer_id", UUID_PATTERN),
    ]


# Landed events may contain a few sentinel records: one row in a thousand is tolerated when a
# whole table is audited. The load gate judges a small slice and passes mostly=1.0.
SENTINEL_TOLERANCE = 0.999


def orders_stream(mostly: float = SENTINEL_TOLERANCE) -> list[Check]:
    return [
        *_shape(schemas.landed("orders_stream")),
        *_not_null("kafka_key event_id event_type order_id customer_id order_status payment_method "
                   "total_amount ingested_at", mostly),
        unique("event_id"),
        in_set("event_type", schemas.ORDER_EVENT_TYPES),
        in_set("order_status", schemas.ORDER_STATUSES),
        in_set("payment_method", schemas.PAYMENT_METHODS),
        in_set("source", ["postgres_cdc"]),
        between("total_amount", 0.01, 100_000.0),
        between("item_count", 1, 1_000),
        between("kafka_offset", 0),
        row_count(1, 10_000_000),
        matches("event_id", UUID_PATTERN, mostly),
        matches("order_id", UUID_PATTERN, mostly),
        matches("customer_id", UUID_PATTERN, mostly),
        references("customer_id", "customers", "customer_id", mostly=0.99),
    ]


def clickstream(mostly: float = SENTINEL_TOLERANCE) -> list[Check]:
    return [
        *_shape(schemas.landed("clickstream")),
        *_not_null("kafka_key event_id event_type session_id page_url device_type time_on_page_ms "
                   "source ingested_at", mostly),
        unique("event_id"),
        in_set("event_type", schemas.CLICK_EVENT_TYPES),
        in_set("device_type", schemas.DEVICE_TYPES),
        in_set("source", ["web_frontend"]),
        between("time_on_page_ms", 0, 3_600_000),
        between("kafka_offset", 0),
        row_count(1, 50_000_000),
    ]


def inventory_updates(mostly: float = SENTINEL_TOLERANCE) -> list[Check]:
    return [
        *_shape(schemas.landed("inventory_updates")),
        *_not_null("kafka_key event_id event_type product_id sku warehouse_id quantity_before "
                   "quantity_change quantity_after reason triggered_by source ingested_at", mostly),
        unique("event_id"),
        in_set("event_type", schemas.INVENTORY_EVENT_TYPES),
        in_set("reason", schemas.INVENTORY_REASONS),
        in_set("triggered_by", schemas.INVENTORY_TRIGGERS),
        in_set("source", ["inventory_service"]),
        between("quantity_before", 0),
        between("quantity_after", 0),
        between("quantity_change", -10_000, 100_000),
        between("kafka_offset", 0),
        row_count(1, 10_000_000),
    ]


SUITES = {
    "customers": customers,
    "orders_history": orders_history,
    "orders_stream": orders_stream,
    "clickstream": clickstream,
    "inventory_updates": inventory_updates,
}

# CHECK constraints of the operational tables.
CONSTRAINTS = {
    "products": [between("unit_price", 0), between("stock_quantity", 0)],
    "orders_history": [
        in_set("order_status", schemas.ORDER_STATUSES),
        between("total_amount", 0),
        in_set("payment_method", schemas.PAYMENT_METHODS),
    ],
    "order_items": [between("quantity", 1), between("unit_price", 0), between("discount", 0, 1)],
}

# Column tests of the models as (not null, unique, accepted values). NULL passes
# the accepted-values test.
STOCK_CLASSES = ("out_of_stock", "critical", "low", "healthy")
FUNNEL_CLASSES = ("purchase", "checkout", "add_to_cart", "product_view", "browse_only")
SESSION_CLASSES = ("converted", "engaged", "active", "bounce")
STAGED_STATUSES = (
    "PENDING", "PROCESSING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED", "REFUNDED",
)
MODEL_TESTS = {
    "stg_customers": ("customer_id email first_name last_name created_at", "customer_id", {}),
    "stg_products": ("product_id supplier_id product_name unit_price is_active", "product_id", {}),
    "stg_suppliers": ("supplier_id supplier_name email", "supplier_id", {}),
    "stg_orders_history": ("order_id customer_id order_status total_amount order_date", "order_id",
                           {"order_status": STAGED_STATUSES}),
    "stg_order_items": ("order_item_id order_id product_id quantity subtotal", "order_item_id", {}),
    "stg_orders_stream": ("event_id order_id customer_id event_timestamp event_type", "event_id", {}),
    "stg_clickstream": ("event_id session_id event_timestamp event_type", "event_id", {}),
    "stg_inventory_updates": ("event_id product_id event_timestamp movement_type", "event_id",
                              {"movement_type": ("restock", "depletion", "adjustment")}),
    "int_order_lines": ("order_item_id order_id product_id customer_id line_revenue", "order_item_id", {}),
    "int_orders_with_customers": ("order_id customer_id total_amount order_date", "order_id", {}),
    "int_streaming_orders_enriched": ("event_id order_id event_timestamp", "event_id", {}),
    "int_clickstream_sessionized": ("session_id session_start funnel_stage session_quality", "session_id",
                                    {"funnel_stage": FUNNEL_CLASSES, "session_quality": SESSION_CLASSES}),
    "int_inventory_enriched": ("event_id product_id event_timestamp movement_type stock_health", "event_id",
                               {"stock_health": STOCK_CLASSES}),
    "mart_orders": ("order_id customer_id order_status order_value_tier order_date total_amount", "order_id",
                    {"order_value_tier": ("high", "medium", "low")}),
    "mart_customers": ("customer_id email customer_segment", "customer_id",
                       {"customer_segment": ("platinum", "gold", "silver", "bronze", "prospect")}),
    "mart_products": ("product_id product_name current_stock_health performance_tier", "product_id",
                      {"current_stock_health": STOCK_CLASSES,
                       "performance_tier": ("top_performer", "strong", "moderate", "low_performer", "no_sales")}),
    "mart_revenue_daily": ("date_day total_orders gross_revenue", "date_day", {}),
    "mart_funnel": ("session_id session_start funnel_stage session_quality", "session_id",
                    {"funnel_stage": FUNNEL_CLASSES, "session_quality": SESSION_CLASSES}),
}


def model_checks(model: str) -> list[Check]:
    required, key, accepted = MODEL_TESTS[model]
    return [*_not_null(required), unique(key), *[in_set(name, values) for name, values in accepted.items()]]


# Hours after which a source is late (warn) or unusable (error).
FRESHNESS_LIMITS = {
    **{name: ("_ingested_at", 24, 48) for name in schemas.BATCH_TABLES},
    **{name: ("_loaded_at", 1, 6) for name in schemas.TOPICS},
}
