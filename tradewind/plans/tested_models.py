"""Models published and tested in one go: each is computed once, and its tests are metrics of that write. Or tested
without being published: only tested columns are computed, and only what several models read is written."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.keys import LAYER_SCHEMAS
from tradewind.operators import quality, suites
from tradewind.plans.warehouse import TABLES, VIEWS, Warehouse

# In an order in which every model comes after those it reads.
LAYERS = {name: layer for part in (VIEWS, TABLES) for layer, names in part.items() for name in names}

# Models whose last step deduplicates or groups by the tested key: its rows lie together already, and counting
# them while they are written shuffles nothing. The keys of the others are read back, that column alone.
GROUPED_BY_KEY = ("stg_customers", "stg_products", "stg_suppliers", "stg_orders_history", "stg_order_items",
                  "mart_products", "mart_revenue_daily")

# Models that several others read, which tests without publication write once; of a mart only what later ones read.
READ_AGAIN = {
    "stg_customers": None, "stg_products": None, "stg_suppliers": None, "stg_orders_history": None,
    "stg_order_items": None, "int_clickstream_sessionized": None,
    "mart_orders": ("order_id", "customer_id", "customer_country", "payment_method", "primary_category",
                    "order_value_tier", "order_date", "order_date_day", "total_amount", "total_discount_amount",
                    "total_line_revenue", "total_units", "order_status", "is_delivered", "is_cancelled", "is_refunded",
                    "days_to_ship"),
}


def run_tests(spark: SparkSession, warehouse: Warehouse, root: str,
              checks_of: Callable[[str], Sequence[quality.Check]] = suites.model_checks) -> DataFrame:
    """Results of the tests of all models, one row per test, as ``publish_tested`` stores them, without publishing.

    A model is read in its tested columns only, so that neither its other columns nor what they alone need are
    computed, sent or written; rows are all judged. Models in ``READ_AGAIN`` are written below ``root`` on the way.
    """
    published, stored = dict(warehouse.published), f"{root}/test_results"
    for name in LAYERS:
        house = Warehouse(warehouse.raw, warehouse.rules, published, warehouse.ties)
        checks = checks_of(name)
        if name in READ_AGAIN:
            model, path = house.model(name), f"{root}/{LAYER_SCHEMAS[LAYERS[name]].lower()}/{name}"
            kept = [c for c in model.columns if READ_AGAIN[name] is None or c in READ_AGAIN[name]
                    or c in {check.column for check in checks}]
            if checks:
                grouped = next((check.column for check in checks if check.kind == "unique"), None)
                results = quality.evaluate_written(
                    model.select(*kept), name, checks, path, grouped if name in GROUPED_BY_KEY else None)
            else:
                model.select(*kept).write.mode("overwrite").parquet(path)
            published[name] = spark.read.parquet(path)
        elif checks:
            results = quality.evaluate(house.model(name).select(*dict.fromkeys(check.column for check in checks)), name, checks)
        if checks:
            results.drop("suite").coalesce(1).write.mode("overwrite").parquet(f"{stored}/suite={name}")
    return spark.read.parquet(stored).select(*quality.RESULT_COLUMNS)


def publish_tested(spark: SparkSession, warehouse: Warehouse, root: str, names: Sequence[str] = tuple(LAYERS),
                   checks_of: Callable[[str], Sequence[quality.Check]] = suites.model_checks,
                   stop_at_failure: bool = False) -> tuple[Warehouse, DataFrame]:
    """Writes the models below ``root`` and returns a warehouse that reads them, and the results of their tests.

    A later model reads what was written, so a model that several others use is computed once. The results have
    one row per test; they are stored below ``root`` too, a partition for each model, written after the model.
    With ``stop_at_failure`` a model that fails a test raises, and nothing that depends on it is computed.
    """
    published, stored = dict(warehouse.published), f"{root}/test_results"
    for name in [name for name in LAYERS if name in names]:
        house = Warehouse(warehouse.raw, warehouse.rules, published, warehouse.ties)
        path = f"{root}/{LAYER_SCHEMAS[LAYERS[name]].lower()}/{name}"
        checks = checks_of(name)
        grouped = next((check.column for check in checks if check.kind == "unique"), None)
        results = quality.evaluate_written(
            house.model(name), name, checks, path, grouped if name in GROUPED_BY_KEY else None)
        results.drop("suite").coalesce(1).write.mode("overwrite").parquet(f"{stored}/suite={name}")
        if stop_at_failure:
            quality.require(spark.read.parquet(f"{stored}/suite={name}"), name)
        published[name] = spark.read.parquet(path)
    results = spark.read.parquet(stored).select(*quality.RESULT_COLUMNS)
    return Warehouse(warehouse.raw, warehouse.rules, published, warehouse.ties), results
