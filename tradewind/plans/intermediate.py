"""Intermediate models: staged rows joined to their context, and clicks folded into sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import classify, money, temporal
from tradewind.operators.aggregates import commonest
from tradewind.operators.joins import keyed, lookup

CUSTOMER_CONTEXT = {
    "full_name": "customer_full_name",
    "email": "customer_email",
    "city": "customer_city",
    "state": "customer_state",
    "country": "customer_country",
}


def sold_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with the context of their order, without product attributes.

    Lines of unknown or rejected orders vanish. The result is partitioned by order, which the
    order-level aggregations downstream reuse.
    """
    order = keyed(orders, "order_id", "_order").select(
        "_order", "customer_id", "order_status", "payment_method",
        "order_date", "shipped_date", "delivered_date", "days_to_ship",
    )
    quantity, price, net = F.col("quantity"), F.col("unit_price"), F.col("effective_unit_price")
    return (
        items.join(order, F.col("order_id") == F.col("_order"), "inner").drop("_order")
        .withColumns({
            "line_revenue": F.round(net * quantity, 2).cast(money.DERIVED),
            "discount_amount": F.round((price - net) * quantity, 2).cast(money.DERIVED),
            "is_discounted": classify.is_true(F.col("discount") > 0),
            **classify.status_flags(F.col("order_status")),
        })
        .withColumnsRenamed({"unit_price": "listed_unit_price", "created_at": "item_created_at"})
    )


def int_order_lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line with order and product context.

    The product is looked up first: the join on the order comes last and leaves the lines
    partitioned by order.
    """
    attributes = ("product_name", "category", "subcategory", "sku", "supplier_id")
    context = {**{name: name for name in attributes}, "is_active": "product_is_active"}
    return sold_lines(lookup(items, products, "product_id", "product_id", context), orders).select(
        "order_item_id", "order_id", "product_id", "customer_id",
        "order_status", "payment_method", "order_date", "shipped_date", "delivered_date", "days_to_ship",
        *attributes, "product_is_active",
        "quantity", "listed_unit_price", "discount", "effective_unit_price", "subtotal",
        "line_revenue", "discount_amount", "is_discounted",
        "is_delivered", "is_cancelled", "is_refunded",
        "item_created_at", "_ingested_at",
    )


def tiered_orders(orders: DataFrame, tier_floors: Sequence = classify.TIER_FLOORS) -> DataFrame:
    """Orders with value tier and status flags: what customer marts need of ``int_orders_with_customers``."""
    tier = classify.order_value_tier(F.col("total_amount"), tier_floors)
    return orders.withColumns({"order_value_tier": tier, **classify.status_flags(F.col("order_status"))})


def int_orders_with_customers(orders: DataFrame, customers: DataFrame,
                              tier_floors: Sequence = classify.TIER_FLOORS) -> DataFrame:
    """One row per order with customer demographics, tenure and value tier."""
    context = {**CUSTOMER_CONTEXT, "created_at": "customer_since"}
    return (
        lookup(orders, customers, "customer_id", "customer_id", context, spread_by=("order_id",))
        .withColumns({
            "customer_tenure_days_at_order": temporal.days_between(F.col("customer_since"), F.col("order_date")),
            "order_value_tier": classify.order_value_tier(F.col("total_amount"), tier_floors),
            **classify.status_flags(F.col("order_status")),
        })
        .select(
            "order_id", "customer_id", *context.values(), "customer_tenure_days_at_order",
            "order_status", "payment_method", "total_amount", "shipping_address",
            "order_date", "shipped_date", "delivered_date", "days_to_ship",
            "is_delivered", "is_cancelled", "is_refunded", "order_value_tier",
            F.col("created_at").alias("order_created_at"), "_ingested_at",
        )
    )


def int_streaming_orders_enriched(events: DataFrame, customers: DataFrame,
                                  tier_floors: Sequence = classify.TIER_FLOORS) -> DataFrame:
    """One row per order event; the customer may not have been loaded yet.

    Also valid as a stream-static join: ``events`` may be a streaming DataFrame.
    """
    enriched = lookup(events, customers, "customer_id", "customer_id", CUSTOMER_CONTEXT,
                      spread_by=("event_id",), matched="customer_matched")
    return enriched.select(
        "event_id", "event_type", "event_timestamp", "event_source",
        "order_id", "customer_id", "order_status", "payment_method", "total_amount", "item_count",
        "shipping_city", "shipping_country", *CUSTOMER_CONTEXT.values(), "customer_matched",
        classify.order_value_tier(F.col("total_amount"), tier_floors).alias("order_value_tier"),
        "kafka_offset", "kafka_partition", "kafka_timestamp", "ingested_at", "_loaded_at",
    )


SESSION_FLAGS = {f"has_{name.lower()}": name
                 for name in ("PAGE_VIEW", "PRODUCT_VIEW", "ADD_TO_CART", "CHECKOUT", "PURCHASE")}


def session_measures() -> list[Column]:
    """What the clicks of a session add up to, but for distinct counts and the user."""
    moment = [F.col("event_timestamp"), F.col("event_id")]
    return [
        F.bool_or(~F.col("is_anonymous")).alias("has_authenticated_event"),
        F.min(F.struct(*moment, "device_type", "browser", "page_url", "referrer")).alias("entry"),
        F.max(F.struct(*moment, "page_url")).alias("exit"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count("*").alias("total_events"),
        money.total(F.col("time_on_page_sec")).alias("total_time_on_site_sec"),
        F.count("time_on_page_sec").alias("timed_events"),
        *[F.bool_or(F.col("event_type") == name).alias(flag) for flag, name in SESSION_FLAGS.items()],
    ]


def session_facts(sessions: DataFrame, active_events: int = classify.ACTIVE_SESSION_EVENTS) -> DataFrame:
    """The columns of a session, from its measures, distinct counts (``pages``, ``products``, ``categories``) and user."""
    zero = F.lit(0).cast("bigint")
    reached = {"product_view": F.col("has_product_view"), "add_to_cart": F.col("has_add_to_cart"),
               "checkout": F.col("has_checkout"), "purchase": F.col("has_purchase")}
    quality = classify.session_quality(F.col("has_purchase"), F.col("has_add_to_cart"),
                                       F.col("total_events"), active_events)
    return sessions.select(
        "session_id", "user_id", "has_authenticated_event",
        F.col("entry.device_type").alias("device_type"), F.col("entry.browser").alias("browser"),
        "session_start", "session_end",
        temporal.seconds_between(F.col("session_start"), F.col("session_end")).alias("session_duration_sec"),
        "total_events",
        F.coalesce("pages", zero).alias("unique_pages_viewed"),
        F.coalesce("products", zero).alias("unique_products_viewed"),
        F.coalesce("categories", zero).alias("unique_categories_viewed"),
        "total_time_on_site_sec",
        money.average(F.col("total_time_on_site_sec"), F.col("timed_events")).alias("avg_time_per_page_sec"),
        F.col("entry.page_url").alias("entry_page"), F.col("exit.page_url").alias("exit_page"),
        F.col("entry.referrer").alias("referrer"),
        *SESSION_FLAGS,
        classify.funnel_stage(reached).alias("funnel_stage"),
        quality.alias("session_quality"),
    )


def int_clickstream_sessionized(clicks: DataFrame,
                                active_events: int = classify.ACTIVE_SESSION_EVENTS) -> DataFrame:
    """One row per session.

    Distinct counts and the most frequent user come from one narrow, counted projection instead of
    three distinct aggregates, which would quadruple the wide rows. Every shuffle sends combined
    rows, so a session that holds a third of the clicks is spread by page, product, category and user.
    """
    # A missing session id is a session of its own; two plain keys keep both sides co-partitioned.
    keyed = clicks.withColumns({
        "_key": F.coalesce(F.col("session_id"), F.lit("")),
        "_unnamed": F.col("session_id").isNull(),
    })
    keys = ["_key", "_unnamed"]

    facets = {"pages": "page_url", "products": "product_id", "categories": "category", "users": "user_id"}
    entries = F.array(*[
        F.struct(F.lit(facet).alias("facet"), F.col(name).alias("value")) for facet, name in facets.items()
    ])
    counted = (
        keyed.select(*keys, F.explode(entries).alias("entry")).select(*keys, "entry.*")
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "facet", "value").agg(F.count("*").alias("clicks"))
    )
    user_rows = counted.withColumn("user", F.when(F.col("facet") == "users", F.col("value")))
    variety = user_rows.groupBy(*keys).agg(
        *[F.count_if(F.col("facet") == facet).alias(facet) for facet in ("pages", "products", "categories")],
        commonest("user", "clicks").alias("user_id"),
    )

    activity = keyed.groupBy(*keys).agg(F.min("session_id").alias("session_id"), *session_measures())
    return session_facts(activity.join(variety, keys, "left"), active_events)


def with_stock_health(inventory: DataFrame, ceilings: Sequence = classify.STOCK_CEILINGS) -> DataFrame:
    return inventory.withColumn("stock_health", classify.stock_health(F.col("quantity_after"), ceilings))


def int_inventory_enriched(inventory: DataFrame, products: DataFrame, suppliers: DataFrame,
                           ceilings: Sequence = classify.STOCK_CEILINGS,
                           large: int = classify.LARGE_MOVEMENT) -> DataFrame:
    """One row per inventory event with product and supplier context.

    Products and suppliers are joined to each other first: the large side is joined only once.
    """
    catalogue = lookup(
        products, suppliers, "supplier_id", "supplier_id",
        {"supplier_name": "supplier_name", "country": "supplier_country"},
    )
    attributes = ("product_name", "category", "subcategory", "unit_price")
    supplied = ("supplier_id", "supplier_name", "supplier_country")
    context = {name: name for name in (*attributes, *supplied)} | {"is_active": "product_is_active"}
    events = with_stock_health(inventory, ceilings)
    moved = F.col("unit_price") * F.abs(F.col("quantity_change"))
    return lookup(events, catalogue, "product_id", "product_id", context, spread_by=("event_id",)).select(
        "event_id", "event_type", "event_timestamp", "movement_type", "reason", "triggered_by", "warehouse_id",
        "product_id", "sku", *attributes, "product_is_active", *supplied,
        "quantity_before", "quantity_change", "quantity_after",
        F.round(moved, 2).cast(money.DERIVED).alias("movement_value"),
        "stock_health",
        classify.is_large_movement(F.col("quantity_change"), large).alias("is_large_movement"),
        "kafka_offset", "kafka_partition", "kafka_timestamp", "ingested_at", "_loaded_at",
    )
