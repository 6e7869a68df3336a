"""Entity schemas: what each source table, event topic and landed table contains."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
BIG = T.LongType()
FLAG = T.BooleanType()
REAL = T.DoubleType()
TIME = T.TimestampType()
MONEY = T.DecimalType(12, 2)
FRACTION = T.DecimalType(12, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, TEXT)


# Columns of the five operational tables.
CUSTOMERS = _struct(
    **_texts("customer_id", "first_name", "last_name", "email", "phone", "address",
             "city", "state", "country", "postal_code"),
    created_at=TIME, updated_at=TIME,
)
SUPPLIERS = _struct(
    **_texts("supplier_id", "supplier_name", "contact_name", "email", "phone",
             "address", "city", "country"),
    created_at=TIME,
)
PRODUCTS = _struct(
    **_texts("product_id", "supplier_id", "product_name", "category", "subcategory"),
    unit_price=MONEY, stock_quantity=INT, sku=TEXT, is_active=FLAG,
    created_at=TIME, updated_at=TIME,
)
ORDERS_HISTORY = _struct(
    **_texts("order_id", "customer_id", "order_status"), total_amount=MONEY,
    **_texts("payment_method", "shipping_address"),
    order_date=TIME, shipped_date=TIME, delivered_date=TIME, created_at=TIME,
)
ORDER_ITEMS = _struct(
    **_texts("order_item_id", "order_id", "product_id"), quantity=INT,
    unit_price=MONEY, discount=FRACTION, subtotal=MONEY, created_at=TIME,
)

# Payload fields of the three event topics.
ORDERS_STREAM = _struct(
    **_texts("event_id", "event_type", "event_timestamp", "order_id", "customer_id",
             "order_status", "payment_method"),
    total_amount=REAL, item_count=INT,
    **_texts("shipping_city", "shipping_country", "source"),
)
CLICKSTREAM = _struct(
    **_texts("event_id", "event_type", "event_timestamp", "session_id", "user_id", "page_url",
             "product_id", "category", "device_type", "browser", "referrer"),
    time_on_page_ms=BIG, source=TEXT,
)
INVENTORY_UPDATES = _struct(
    **_texts("event_id", "event_type", "event_timestamp", "product_id", "sku", "warehouse_id"),
    quantity_before=INT, quantity_change=INT, quantity_after=INT,
    **_texts("reason", "triggered_by", "source"),
)

BATCH_TABLES = {
    "customers": CUSTOMERS,
    "suppliers": SUPPLIERS,
    "products": PRODUCTS,
    "orders_history": ORDERS_HISTORY,
    "order_items": ORDER_ITEMS,
}
TOPICS = {
    "orders_stream": ORDERS_STREAM,
    "clickstream": CLICKSTREAM,
    "inventory_updates": INVENTORY_UPDATES,
}
PRIMARY_KEYS = {
    "customers": "customer_id",
    "suppliers": "supplier_id",
    "products": "product_id",
    "orders_history": "order_id",
    "order_items": "order_item_id",
}
FOREIGN_KEYS = (
    # child table, child column, parent table
    ("products", "supplier_id", "suppliers"),
    ("orders_history", "customer_id", "customers"),
    ("order_items", "order_id", "orders_history"),
    ("order_items", "product_id", "products"),
)

# Broker metadata put before, and ingest time put after, the payload of a landed event.
BROKER_COLUMNS = ("kafka_key", "kafka_offset", "kafka_partition", "kafka_timestamp")
HOUR_PARTITIONS = ("year", "month", "day", "hour")


def landed(topic: str) -> T.StructType:
    """Columns stored in the files of a landed topic (partition columns live in the path)."""
    head = _struct(kafka_key=TEXT, kafka_offset=BIG, kafka_partition=INT, kafka_timestamp=TIME)
    return T.StructType(head.fields + TOPICS[topic].fields + [T.StructField("ingested_at", TIME)])


# Enumerations shared by checks and plans.
ORDER_STATUSES = ("cancelled", "confirmed", "delivered", "pending", "processing", "refunded", "shipped")
PAYMENT_METHODS = ("bank_transfer", "credit_card", "crypto", "debit_card", "paypal")
ORDER_EVENT_TYPES = ("order_cancelled", "order_created", "order_updated")
CLICK_EVENT_TYPES = ("add_to_cart", "checkout", "page_view", "product_view", "purchase")
DEVICE_TYPES = ("desktop", "mobile", "tablet")
INVENTORY_EVENT_TYPES = ("adjustment", "low_stock_alert", "restock", "sale_deduction")
INVENTORY_REASONS = (
    "auto_threshold_trigger", "bulk_order", "damage_writeoff", "expiry_removal",
    "inventory_audit", "manual_review", "order_fulfilled", "return_processed",
    "subscription_fulfillment", "supplier_delivery", "transfer_in",
)
INVENTORY_TRIGGERS = ("manual", "order_fulfillment", "system")
