"""Staging: cleaned source rows. Batch tables keep the latest version per key, events keep all rows.

The event functions contain no aggregation or window, so they run unchanged on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import classify, money, temporal
from tradewind.functions.text import full_name, is_anonymous, lowered, trimmed, uppered
from tradewind.operators.dedup import keep_latest

Ties = Sequence[str] | None


def _parsed(name: str) -> Column:
    return temporal.parse_time(name).alias(name)


def _whole(name: str) -> Column:
    return F.col(name).cast("int").alias(name)


def _trace() -> list[Column]:
    """Broker and load metadata every staged event carries."""
    return [
        *map(F.col, ("kafka_offset", "kafka_partition", "kafka_timestamp")),
        F.col("source").alias("event_source"),
        *map(F.col, ("ingested_at", "_loaded_at", "_source_file")),
    ]


def _readable_events(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("event_id").isNotNull() & temporal.parse_time("event_timestamp").isNotNull())


def stg_customers(raw: DataFrame, ties: Ties = None) -> DataFrame:
    latest = keep_latest(raw.where(F.col("customer_id").isNotNull()), "customer_id", ties=ties)
    return latest.select(
        "customer_id",
        trimmed("first_name"), trimmed("last_name"),
        full_name("first_name", "last_name").alias("full_name"),
        lowered("email"),
        *map(trimmed, ("phone", "address", "city", "state", "country", "postal_code")),
        "created_at", "updated_at", "_ingested_at",
    )


def stg_products(raw: DataFrame, ties: Ties = None) -> DataFrame:
    latest = keep_latest(raw.where(F.col("product_id").isNotNull()), "product_id", ties=ties)
    return latest.select(
        "product_id", "supplier_id",
        *map(trimmed, ("product_name", "category", "subcategory", "sku")),
        money.amount("unit_price"), _whole("stock_quantity"),
        "is_active", "created_at", "updated_at", "_ingested_at",
    )


def stg_suppliers(raw: DataFrame, ties: Ties = None) -> DataFrame:
    latest = keep_latest(raw.where(F.col("supplier_id").isNotNull()), "supplier_id", ties=ties)
    return latest.select(
        "supplier_id", trimmed("supplier_name"), trimmed("contact_name"), lowered("email"),
        *map(trimmed, ("phone", "address", "city", "country")),
        "created_at", "_ingested_at",
    )


def stg_orders_history(raw: DataFrame, ties: Ties = None) -> DataFrame:
    """Rows whose order or creation time cannot be read are dropped before the latest is chosen,
    so an older readable version survives a newer broken one."""
    readable = raw.where(
        F.col("order_id").isNotNull()
        & temporal.parse_time("order_date").isNotNull()
        & temporal.parse_time("created_at").isNotNull()
    )
    cleaned = keep_latest(readable, "order_id", ties=ties).select(
        "order_id", "customer_id",
        uppered("order_status"), uppered("payment_method"), trimmed("shipping_address"),
        money.amount("total_amount"),
        *map(_parsed, ("order_date", "shipped_date", "delivered_date", "created_at")),
        "_ingested_at",
    )
    days_to_ship = temporal.days_between(F.col("order_date"), F.col("shipped_date"))
    return cleaned.withColumn("days_to_ship", days_to_ship)


def stg_order_items(raw: DataFrame, ties: Ties = None) -> DataFrame:
    latest = keep_latest(raw.where(F.col("order_item_id").isNotNull()), "order_item_id", ties=ties)
    return latest.select(
        "order_item_id", "order_id", "product_id",
        _whole("quantity"), money.amount("unit_price"), money.fraction("discount"), money.amount("subtotal"),
        money.net_unit_price("unit_price", "discount").alias("effective_unit_price"),
        "created_at", "_ingested_at",
    )


def stg_orders_stream(raw: DataFrame) -> DataFrame:
    return _readable_events(raw).select(
        "event_id", uppered("event_type"), _parsed("event_timestamp"),
        "order_id", "customer_id", uppered("order_status"), uppered("payment_method"),
        money.amount("total_amount"), _whole("item_count"),
        trimmed("shipping_city"), trimmed("shipping_country"),
        *_trace(),
    )


def stg_clickstream(raw: DataFrame) -> DataFrame:
    """Time on page is kept as exact decimal seconds, so that sums do not depend on row order."""
    seconds = F.round(F.col("time_on_page_ms").cast("decimal(12,0)") / F.lit(1000).cast("decimal(4,0)"), 2)
    return _readable_events(raw).select(
        "event_id", "session_id", uppered("event_type"), _parsed("event_timestamp"),
        "user_id", is_anonymous("user_id").alias("is_anonymous"),
        trimmed("page_url"), "product_id", trimmed("category"),
        lowered("device_type"), lowered("browser"), trimmed("referrer"),
        _whole("time_on_page_ms"), seconds.cast(money.AMOUNT).alias("time_on_page_sec"),
        *_trace(),
    )


def stg_inventory_updates(raw: DataFrame) -> DataFrame:
    return _readable_events(raw).select(
        "event_id", uppered("event_type"), _parsed("event_timestamp"),
        "product_id", trimmed("sku"), trimmed("warehouse_id"),
        *map(_whole, ("quantity_before", "quantity_change", "quantity_after")),
        classify.movement_type(F.col("quantity_change").cast("int")).alias("movement_type"),
        trimmed("reason"), trimmed("triggered_by"),
        *_trace(),
    )
