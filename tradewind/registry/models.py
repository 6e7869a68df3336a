"""The models: staging (STG), intermediate and marts (MDL)."""

from __future__ import annotations

from tradewind.registry.oracle import model_sql
from tradewind.registry.register import Register
from tradewind.sources.star_tables import warehouse

REGISTER = Register()

MODELS = {
    "stg01_customers": "stg_customers",
    "stg02_products": "stg_products",
    "stg03_suppliers": "stg_suppliers",
    "stg04_orders_history": "stg_orders_history",
    "stg05_order_items": "stg_order_items",
    "stg06_orders_stream": "stg_orders_stream",
    "stg07_clickstream": "stg_clickstream",
    "stg08_inventory_updates": "stg_inventory_updates",
    "mdl01_order_lines": "int_order_lines",
    "mdl02_orders_with_customers": "int_orders_with_customers",
    "mdl03_streaming_orders_enriched": "int_streaming_orders_enriched",
    "mdl04_clickstream_sessionized": "int_clickstream_sessionized",
    "mdl05_inventory_enriched": "int_inventory_enriched",
    "mdl06_orders": "mart_orders",
    "mdl07_customers": "mart_customers",
    "mdl08_products": "mart_products",
    "mdl09_revenue_daily": "mart_revenue_daily",
    "mdl10_funnel": "mart_funnel",
}


def _model(model: str):
    return lambda spark, folder: warehouse(spark, folder).model(model)


for _name, _table in MODELS.items():
    REGISTER.add(_name, _model(_table), model_sql(_table))
