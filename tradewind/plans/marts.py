"""Marts: the tables dashboards read.

The aggregations run in steps from fine to coarse grain. Distinct counts and most frequent values
fall out of the steps, so no step multiplies rows and each one combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions import classify, money, temporal
from tradewind.operators.aggregates import commonest
from tradewind.operators.joins import lookup


def _sums(*names: str) -> list[Column]:
    """Carry counts or money upwards by summing them again."""
    return [F.sum(name).alias(name) for name in names]


def _totals(*names: str) -> list[Column]:
    return [money.total(F.col(name)).alias(name) for name in names]


def _zero_if_absent(name: str, alias: str | None = None) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(alias or name)


def order_line_summary(lines: DataFrame) -> DataFrame:
    """One row per order. A product has one category, so its distinct count adds up over categories.

    Lines arrive partitioned by order; all three steps reuse that and shuffle nothing.
    """
    by_product = lines.groupBy("order_id", "category", "product_id").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units"),
        *_totals("line_revenue", "discount_amount"),
        F.sum("discount").cast("decimal(24,4)").alias("discount"),
        F.bool_or("is_discounted").alias("is_discounted"),
    )
    by_category = by_product.groupBy("order_id", "category").agg(
        *_sums("lines", "units"), *_totals("line_revenue", "discount_amount"),
        F.sum("discount").cast("decimal(24,4)").alias("discount"),
        F.bool_or("is_discounted").alias("is_discounted"),
        F.count("product_id").alias("products"),
    )
    by_order = by_category.groupBy("order_id").agg(
        *_sums("lines", "units", "products"), *_totals("line_revenue", "discount_amount"),
        F.sum("discount").cast("decimal(24,4)").alias("discount"),
        F.bool_or("is_discounted").alias("has_discounted_item"),
        F.count("category").alias("distinct_categories"),
        commonest("category", "lines").alias("primary_category"),
    )
    return by_order.select(
        "order_id",
        F.col("lines").alias("line_item_count"),
        F.col("units").alias("total_units"),
        F.col("line_revenue").alias("total_line_revenue"),
        F.col("discount_amount").alias("total_discount_amount"),
        money.average(F.col("discount"), F.col("lines"), 8).alias("avg_discount_rate"),
        F.col("products").alias("distinct_products"),
        "distinct_categories", "has_discounted_item", "primary_category",
    )


def mart_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order with its line summary and calendar columns."""
    counted = ("total_line_revenue", "total_discount_amount", "avg_discount_rate",
               "line_item_count", "total_units", "distinct_products", "distinct_categories")
    calendar = temporal.order_calendar(F.col("order_date"))
    summary = order_line_summary(lines).withColumnRenamed("order_id", "_order")
    return (
        orders.join(summary, F.col("order_id") == F.col("_order"), "left")
        .withColumns(calendar)
        .select(
            "order_id", "customer_id",
            "customer_full_name", "customer_email", "customer_city", "customer_state", "customer_country",
            "customer_since", "customer_tenure_days_at_order",
            "order_status", "payment_method", "order_value_tier",
            "order_date", "shipped_date", "delivered_date", "days_to_ship",
            "is_delivered", "is_cancelled", "is_refunded", "total_amount",
            *map(_zero_if_absent, counted),
            "has_discounted_item", "primary_category",
            *calendar, "order_created_at", "_ingested_at",
        )
    )


def priced_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with the units and money of their lines: what daily revenue needs of ``mart_orders``.

    ``lines`` needs no product attributes (``sold_lines``), so products are neither read nor joined.
    """
    totals = lines.groupBy(F.col("order_id").alias("_order")).agg(
        F.sum("quantity").alias("total_units"),
        money.total(F.col("line_revenue")).alias("total_line_revenue"),
        money.total(F.col("discount_amount")).alias("total_discount_amount"),
    )
    joined = orders.join(totals, F.col("order_id") == F.col("_order"), "left").drop("_order")
    return joined.withColumns({
        **{name: _zero_if_absent(name) for name in ("total_units", "total_line_revenue", "total_discount_amount")},
        "order_date_day": temporal.order_calendar(F.col("order_date"))["order_date_day"],
    })


def summarised_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with the line summary that ``mart_customers`` needs of ``mart_orders``; customers are not joined."""
    summary = order_line_summary(lines).withColumnRenamed("order_id", "_order")
    joined = orders.join(summary, F.col("order_id") == F.col("_order"), "left")
    return joined.withColumn("total_discount_amount", _zero_if_absent("total_discount_amount"))


# output name -> column whose most frequent value a customer gets
FAVOURITES = {
    "preferred_payment_method": "payment_method",
    "preferred_category": "primary_category",
    "typical_order_tier": "order_value_tier",
}


# Columns of orders that the customer mart reads.
CUSTOMER_ORDER_COLUMNS = ("order_id", "customer_id", *FAVOURITES.values(), "is_delivered", "is_cancelled", "is_refunded",
                          "total_amount", "total_discount_amount", "order_date")


def customer_order_summary(orders: DataFrame) -> DataFrame:
    """One row per customer with orders.

    Orders are counted per combination of the values that compete to be the most frequent. Only these
    counts are brought together by customer; a value's orders are added up over the combinations.
    """
    counts = ("total_orders", "delivered_orders", "cancelled_orders", "refunded_orders", "priced_orders")
    totals = ("lifetime_value", "total_discounts_received")
    combined = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id", *FAVOURITES.values()).agg(
        F.count("*").alias("total_orders"),
        F.count_if("is_delivered").alias("delivered_orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        F.count_if("is_refunded").alias("refunded_orders"),
        F.count("total_amount").alias("priced_orders"),
        money.total(F.col("total_amount")).alias("lifetime_value"),
        money.total(F.col("total_discount_amount")).alias("total_discounts_received"),
        F.max("total_amount").alias("max_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    weighed = combined.repartition("customer_id")
    for alias, value in FAVOURITES.items():
        orders_of_value = F.sum("total_orders").over(Window.partitionBy("customer_id", value))
        weighed = weighed.withColumn(f"_{alias}", orders_of_value)
    return weighed.groupBy("customer_id").agg(
        *_sums(*counts), *_totals(*totals),
        F.max("max_order_value").alias("max_order_value"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        *[commonest(value, f"_{alias}").alias(alias) for alias, value in FAVOURITES.items()],
    )


def mart_customers(customers: DataFrame, orders: DataFrame, as_of: datetime,
                   segment_floors: Sequence = classify.SEGMENT_FLOORS,
                   active_days: int = classify.ACTIVE_DAYS) -> DataFrame:
    """One row per customer as seen at ``as_of``; customers without orders are kept as prospects.

    Lifetime value counts every order, also cancelled and refunded ones.
    """
    summary = customer_order_summary(orders).withColumnRenamed("customer_id", "_customer")
    orders_made, value = F.coalesce("total_orders", F.lit(0)), F.coalesce("lifetime_value", F.lit(0))
    idle = temporal.days_between(F.col("last_order_date"), F.lit(as_of).cast("timestamp"))
    average = money.average(F.col("lifetime_value"), F.col("priced_orders"))
    return (
        customers.join(summary, F.col("customer_id") == F.col("_customer"), "left")
        .select(
            "customer_id", "full_name", "email", "phone", "city", "state", "country", "postal_code",
            F.col("created_at").alias("customer_since"),
            *map(_zero_if_absent, ("total_orders", "delivered_orders", "cancelled_orders", "refunded_orders",
                                   "lifetime_value")),
            F.coalesce(average, F.lit(0)).alias("avg_order_value"),
            *map(_zero_if_absent, ("max_order_value", "total_discounts_received")),
            "first_order_date", "last_order_date",
            temporal.days_between(F.col("first_order_date"), F.col("last_order_date"))
            .alias("days_between_first_last_order"),
            "preferred_payment_method", "preferred_category", "typical_order_tier",
            idle.alias("days_since_last_order"),
            classify.customer_segment(value, orders_made, segment_floors).alias("customer_segment"),
            classify.is_true(idle <= active_days).alias("is_active_customer"),
            money.share(F.col("delivered_orders"), F.col("total_orders")).alias("delivery_rate"),
            money.share(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate"),
            "_ingested_at",
        )
    )


def product_sales(lines: DataFrame) -> DataFrame:
    """One row per product sold. An order has one customer, so distinct orders add up over customers.

    The first step needs no shuffle (lines are partitioned by order); the second spreads a product
    that makes up a third of all lines over its customers.
    """
    by_order = lines.where(classify.kept_sale()).groupBy("product_id", "customer_id", "order_id").agg(
        F.sum("quantity").alias("units"),
        *_totals("line_revenue", "discount_amount"),
        F.count("line_revenue").alias("lines"),
        F.sum("discount").cast("decimal(24,4)").alias("discount"),
        F.count("discount").alias("rated_lines"),
        F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale"),
    )

    def raised(rows, *keys, **counts):
        return rows.groupBy(*keys).agg(
            *_sums("units", "lines", "rated_lines"), *_totals("line_revenue", "discount_amount"),
            F.sum("discount").cast("decimal(24,4)").alias("discount"),
            F.min("first_sale").alias("first_sale"), F.max("last_sale").alias("last_sale"),
            *[count.alias(name) for name, count in counts.items()],
        )

    by_customer = raised(by_order, "product_id", "customer_id", orders=F.count("order_id"))
    by_product = raised(by_customer, "product_id", orders=F.sum("orders"), customers=F.count("customer_id"))
    return by_product.select(
        F.col("product_id").alias("_sold"),
        F.col("orders").alias("total_orders"),
        F.col("units").alias("total_units_sold"),
        F.col("line_revenue").alias("total_revenue"),
        money.average(F.col("line_revenue"), F.col("lines")).alias("avg_revenue_per_order"),
        F.col("discount_amount").alias("total_discount_given"),
        money.average(F.col("discount"), F.col("rated_lines"), 8).alias("avg_discount_rate"),
        F.col("customers").alias("unique_customers"),
        F.col("first_sale").alias("first_sale_date"),
        F.col("last_sale").alias("last_sale_date"),
    )


def inventory_levels(inventory: DataFrame) -> DataFrame:
    """One row per product with events: the latest level and the units moved."""
    moved = F.abs(F.col("quantity_change"))
    latest = F.max(F.struct("event_timestamp", "event_id", "quantity_after", "stock_health"))

    def units(kind):
        return F.sum(F.when(F.col("movement_type") == kind, moved).otherwise(0))

    return inventory.groupBy(F.col("product_id").alias("_stocked")).agg(
        latest.alias("latest"),
        F.count("*").alias("total_inventory_events"),
        units("restock").alias("total_units_restocked"),
        units("depletion").alias("total_units_depleted"),
    )


def mart_products(products: DataFrame, suppliers: DataFrame, lines: DataFrame, inventory: DataFrame,
                  performance_floors: Sequence = classify.PERFORMANCE_FLOORS,
                  ceilings: Sequence = classify.STOCK_CEILINGS) -> DataFrame:
    """One row per product: sales without cancelled and refunded orders, and stock.

    ``lines`` needs no product attributes (``sold_lines``) and ``inventory`` only stock health
    (``with_stock_health``); the fully enriched tables work as well.
    """
    revenue, units = F.coalesce("total_revenue", F.lit(0)), F.col("total_units_sold")
    per_unit = F.round(F.try_divide(F.col("total_revenue").cast("decimal(28,2)"), units.cast("decimal(13,0)")), 2)
    supplied = lookup(products, suppliers, "supplier_id", "supplier_id",
                      {"supplier_name": "supplier_name", "country": "supplier_country"})
    return (
        supplied
        .join(product_sales(lines), F.col("product_id") == F.col("_sold"), "left")
        .join(inventory_levels(inventory), F.col("product_id") == F.col("_stocked"), "left")
        .select(
            "product_id", "product_name", "category", "subcategory", "sku", "unit_price", "is_active",
            "supplier_id", "supplier_name", "supplier_country",
            *map(_zero_if_absent, ("total_orders", "total_units_sold", "total_revenue", "avg_revenue_per_order",
                                   "total_discount_given", "avg_discount_rate", "unique_customers")),
            "first_sale_date", "last_sale_date",
            F.coalesce(F.col("latest.quantity_after"), F.col("stock_quantity")).alias("current_stock"),
            F.coalesce(F.col("latest.stock_health"), classify.stock_health(F.col("stock_quantity"), ceilings))
            .alias("current_stock_health"),
            *map(_zero_if_absent, ("total_inventory_events", "total_units_restocked", "total_units_depleted")),
            F.col("latest.event_timestamp").alias("last_inventory_update"),
            F.when(F.coalesce(units, F.lit(0)) > 0, per_unit).otherwise(0).cast(money.DERIVED)
            .alias("revenue_per_unit_sold"),
            classify.performance_tier(revenue, performance_floors).alias("performance_tier"),
            "created_at", "_ingested_at",
        )
    )


TIERS = ("high", "medium", "low")
# Payment methods with a column of their own.
REPORTED_PAYMENTS = ("CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "BANK_TRANSFER")


def mart_revenue_daily(orders: DataFrame) -> DataFrame:
    """One row per day with sales; days without any are absent.

    Grouped by day, customer and country first, then by day and country, then by day: after the
    first step a day holds at most one row per customer, after the second one per country. The
    other calendar columns follow from the day and are computed last.
    """
    additive = {
        "total_units_sold": F.sum("total_units"),
        "gross_revenue": money.total(F.col("total_amount")),
        "net_revenue": money.total(F.col("total_line_revenue")),
        "total_discounts": money.total(F.col("total_discount_amount")),
    }
    counts = {
        "total_orders": F.count("order_id"),
        "priced_orders": F.count("total_amount"),
        **{f"{tier}_value_orders": F.count_if(F.col("order_value_tier") == tier) for tier in TIERS},
        **{f"{name.lower()}_orders": F.count_if(F.col("payment_method") == name) for name in REPORTED_PAYMENTS},
        "delivered_orders": F.count_if("is_delivered"),
        "shipped_orders": F.count("days_to_ship"),
        "shipping_days": F.sum("days_to_ship"),
        "orders": F.count("*"),
    }
    measures = {**additive, **counts}
    again = [
        (money.total(F.col(name)) if name in additive and name != "total_units_sold" else F.sum(name)).alias(name)
        for name in measures
    ]
    day = F.col("order_date_day").alias("date_day")
    by_customer = orders.where(classify.kept_sale()).groupBy(day, "customer_country", "customer_id").agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    by_country = by_customer.groupBy("date_day", "customer_country").agg(
        *again, F.count("customer_id").alias("unique_customers"),
    )
    by_day = by_country.groupBy("date_day").agg(
        *again, F.sum("unique_customers").alias("unique_customers"),
        commonest("customer_country", "orders").alias("top_customer_country"),
    )
    calendar = temporal.order_calendar(F.col("date_day").cast("timestamp"))
    calendar.pop("order_date_day")
    return by_day.select(
        "date_day", *[column.alias(name) for name, column in calendar.items()],
        "total_orders", "unique_customers", *additive,
        money.average(F.col("gross_revenue"), F.col("priced_orders")).alias("avg_order_value"),
        *[f"{tier}_value_orders" for tier in TIERS],
        *[f"{name.lower()}_orders" for name in REPORTED_PAYMENTS],
        "top_customer_country", "delivered_orders",
        money.average(F.col("shipping_days"), F.col("shipped_orders")).alias("avg_days_to_ship"),
    )


def mart_funnel(sessions: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per session with the customer, if the session's user is one."""
    start = F.col("session_start")
    unbought = ~F.col("has_purchase")
    context = {"full_name": "customer_full_name", "email": "customer_email", "country": "customer_country"}
    enriched = lookup(sessions, customers, "user_id", "customer_id", context,
                      spread_by=("session_id",), matched="is_known_customer")
    return enriched.select(
        "session_id", "user_id", *context.values(), "has_authenticated_event", "is_known_customer",
        "device_type", "browser", "session_start", "session_end", "session_duration_sec",
        F.to_date(start).alias("session_date"),
        F.date_trunc("week", start).alias("session_week"),
        F.date_trunc("month", start).alias("session_month"),
        F.hour(start).alias("session_hour"),
        "total_events", "unique_pages_viewed", "unique_products_viewed", "unique_categories_viewed",
        "total_time_on_site_sec", "avg_time_per_page_sec", "entry_page", "exit_page", "referrer",
        "has_page_view", "has_product_view", "has_add_to_cart", "has_checkout", "has_purchase",
        "funnel_stage", "session_quality",
        classify.funnel_stage_number(F.col("funnel_stage")).alias("funnel_stage_num"),
        (F.col("funnel_stage") == "purchase").alias("converted"),
        classify.is_true(F.col("has_add_to_cart") & unbought).alias("cart_abandoned"),
        classify.is_true(F.col("has_checkout") & unbought).alias("checkout_abandoned"),
    )
