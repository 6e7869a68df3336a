"""Order events produced from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.text import city_of, country_of
from tradewind.operators.ranking import top_n

EVENT_FIELDS = (
    "order_id", "customer_id", "order_status", "payment_method", "total_amount", "item_count",
    "shipping_city", "shipping_country",
)


def item_counts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with the number of their items; 0 for orders without any.

    Items are counted before the join, so an order with very many items joins one row.
    """
    counted = items.groupBy(F.col("order_id").alias("_order")).agg(F.count("order_item_id").alias("item_count"))
    joined = orders.join(counted, F.col("order_id") == F.col("_order"), "left").drop("_order")
    return joined.withColumn("item_count", F.coalesce(F.col("item_count"), F.lit(0)))


def recent_orders(orders: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The n newest orders as events, each with its JSON payload.

    The newest orders are chosen first: only their items are counted and joined.
    """
    chosen = top_n(orders, n, F.desc("order_date"), F.desc("order_id"))
    wanted = items.join(chosen.select("order_id"), "order_id", "left_semi")
    events = item_counts(chosen, wanted).withColumns({
        "shipping_city": city_of("shipping_address"),
        "shipping_country": country_of("shipping_address"),
    })
    shaped = events.select(*[
        F.col(name).cast("double").alias(name) if name == "total_amount" else F.col(name) for name in EVENT_FIELDS
    ])
    return shaped.withColumn("payload", F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"}))
