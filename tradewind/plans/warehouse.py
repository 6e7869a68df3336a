"""The model graph: which model is computed from which, as one lazily planned whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions import classify
from tradewind.functions.keys import LAYER_SCHEMAS
from tradewind.plans import intermediate, marts, staging
from tradewind.session import shuffles_removed


@dataclass(frozen=True)
class Rules:
    """Business parameters; the defaults are the business values."""

    as_of: datetime
    tier_floors: Sequence = classify.TIER_FLOORS
    segment_floors: Sequence = classify.SEGMENT_FLOORS
    performance_floors: Sequence = classify.PERFORMANCE_FLOORS
    stock_ceilings: Sequence = classify.STOCK_CEILINGS
    active_days: int = classify.ACTIVE_DAYS
    active_session_events: int = classify.ACTIVE_SESSION_EVENTS
    large_movement: int = classify.LARGE_MOVEMENT


# Columns that rank rows of one key and one load, per batch table. A load of most tables holds a key once, so
# nothing has to be ranked and only what a model selects is read. Order items may come twice in a load. Orders
# feed two branches of the order models; they share one deduplication because both read all columns.
TIES: Mapping[str, Sequence[str] | None] = {
    "customers": (), "products": (), "suppliers": (), "orders_history": None,
    "order_items": ("order_id", "product_id", "quantity", "unit_price", "discount", "subtotal", "created_at"),
}


@dataclass
class Warehouse:
    """Models over the raw tables. Nothing runs until a model is written or read.

    ``published`` holds tables already materialised (marts are tables, the rest are views); a
    model found there is read instead of being computed again. Where a load of a table can hold a
    key more than once, pass its ``ties`` (None ranks by all columns).
    """

    raw: Mapping[str, DataFrame]
    rules: Rules
    published: Mapping[str, DataFrame] = field(default_factory=dict)
    ties: Mapping[str, Sequence[str] | None] = field(default_factory=lambda: TIES)

    def model(self, name: str) -> DataFrame:
        return self.published[name] if name in self.published else getattr(self, name)

    # staging
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"], self.ties.get("customers"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"], self.ties.get("products"))

    @cached_property
    def stg_suppliers(self) -> DataFrame:
        return staging.stg_suppliers(self.raw["suppliers"], self.ties.get("suppliers"))

    @cached_property
    def stg_orders_history(self) -> DataFrame:
        return staging.stg_orders_history(self.raw["orders_history"], self.ties.get("orders_history"))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"], self.ties.get("order_items"))

    @cached_property
    def stg_orders_stream(self) -> DataFrame:
        return staging.stg_orders_stream(self.raw["orders_stream"])

    @cached_property
    def stg_clickstream(self) -> DataFrame:
        return staging.stg_clickstream(self.raw["clickstream"])

    @cached_property
    def stg_inventory_updates(self) -> DataFrame:
        return staging.stg_inventory_updates(self.raw["inventory_updates"])

    # intermediate
    @cached_property
    def int_order_lines(self) -> DataFrame:
        return intermediate.int_order_lines(
            self.model("stg_order_items"), self.model("stg_orders_history"), self.model("stg_products"))

    @cached_property
    def int_orders_with_customers(self) -> DataFrame:
        return intermediate.int_orders_with_customers(
            self.model("stg_orders_history"), self.model("stg_customers"), self.rules.tier_floors)

    @cached_property
    def int_streaming_orders_enriched(self) -> DataFrame:
        return intermediate.int_streaming_orders_enriched(
            self.model("stg_orders_stream"), self.model("stg_customers"), self.rules.tier_floors)

    @cached_property
    def int_clickstream_sessionized(self) -> DataFrame:
        return intermediate.int_clickstream_sessionized(
            self.model("stg_clickstream"), self.rules.active_session_events)

    @cached_property
    def int_inventory_enriched(self) -> DataFrame:
        return intermediate.int_inventory_enriched(
            self.model("stg_inventory_updates"), self.model("stg_products"), self.model("stg_suppliers"),
            self.rules.stock_ceilings, self.rules.large_movement)

    # marts
    @cached_property
    def mart_orders(self) -> DataFrame:
        return marts.mart_orders(self.model("int_orders_with_customers"), self.model("int_order_lines"))

    @cached_property
    def customer_orders(self) -> DataFrame:
        """Orders as the customer mart needs them: a published order mart is read; otherwise customers are not joined."""
        if "mart_orders" in self.published:
            return self.published["mart_orders"]
        orders = intermediate.tiered_orders(self.model("stg_orders_history"), self.rules.tier_floors)
        return marts.summarised_orders(orders, self.model("int_order_lines"))

    @cached_property
    def mart_customers(self) -> DataFrame:
        return marts.mart_customers(
            self.model("stg_customers"), self.model("customer_orders"), self.rules.as_of,
            self.rules.segment_floors, self.rules.active_days)

    @cached_property
    def mart_products(self) -> DataFrame:
        """Sales and stock need neither product nor supplier columns, so those joins are left out."""
        sold = intermediate.sold_lines(self.model("stg_order_items"), self.model("stg_orders_history"))
        stock = intermediate.with_stock_health(self.model("stg_inventory_updates"), self.rules.stock_ceilings)
        return marts.mart_products(
            self.model("stg_products"), self.model("stg_suppliers"), sold, stock,
            self.rules.performance_floors, self.rules.stock_ceilings)

    @cached_property
    def mart_revenue_daily(self) -> DataFrame:
        """A published order mart is read, or published lines; otherwise orders are priced without looking up products."""
        if "mart_orders" in self.published:
            return marts.mart_revenue_daily(self.published["mart_orders"])
        sold = self.published.get("int_order_lines")
        if sold is None:
            sold = intermediate.sold_lines(self.model("stg_order_items"), self.model("stg_orders_history"))
        return marts.mart_revenue_daily(marts.priced_orders(self.model("int_orders_with_customers"), sold))

    @cached_property
    def mart_funnel(self) -> DataFrame:
        return marts.mart_funnel(self.model("int_clickstream_sessionized"), self.model("stg_customers"))


VIEWS = {
    "staging": (
        "stg_customers", "stg_products", "stg_suppliers", "stg_orders_history", "stg_order_items",
        "stg_orders_stream", "stg_clickstream", "stg_inventory_updates",
    ),
    "intermediate": (
        "int_order_lines", "int_orders_with_customers", "int_streaming_orders_enriched",
        "int_clickstream_sessionized", "int_inventory_enriched",
    ),
}
# In this order, so that later marts read mart_orders instead of computing it again.
TABLES = {"marts": ("mart_orders", "mart_customers", "mart_products", "mart_revenue_daily", "mart_funnel")}


def register_views(warehouse: Warehouse) -> list[str]:
    """Views for the staging and intermediate layers."""
    names = [name for layer in VIEWS.values() for name in layer]
    for name in names:
        warehouse.model(name).createOrReplaceTempView(name)
    return names


def publish_marts(spark: SparkSession, warehouse: Warehouse, root: str,
                  names: Sequence[str] = TABLES["marts"]) -> Warehouse:
    """Rebuild the mart tables below ``root`` and return a warehouse that reads them."""
    published = dict(warehouse.published)
    for name in names:
        path = f"{root}/{LAYER_SCHEMAS['marts'].lower()}/{name}"
        house = Warehouse(warehouse.raw, warehouse.rules, published, warehouse.ties)
        with shuffles_removed(spark):
            house.model(name).write.mode("overwrite").parquet(path)
        published[name] = spark.read.parquet(path)
    return Warehouse(warehouse.raw, warehouse.rules, published, warehouse.ties)
