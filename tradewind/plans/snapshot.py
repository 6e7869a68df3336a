"""History of customer segments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.operators.history import apply_history, start_history
from tradewind.operators.history_table import read_history, run_history

KEY = "customer_id"
# A change in one of these opens a new version; the other columns just ride along.
CHECKED = ("customer_segment", "lifetime_value", "total_orders", "is_active_customer")
KEPT = (
    "customer_id", "full_name", "email", "customer_segment", "lifetime_value", "total_orders",
    "is_active_customer", "days_since_last_order", "preferred_category",
)


def segment_state(customers_mart: DataFrame, as_of: datetime) -> DataFrame:
    return customers_mart.select(*KEPT, F.lit(as_of).cast("timestamp").alias("snapshotted_at"))


def customer_segments_snapshot(history: DataFrame | None, customers_mart: DataFrame, as_of: datetime,
                               close_missing: bool = True) -> DataFrame:
    """History after one more run; ``None`` starts it. Customers gone from the mart are closed."""
    current = segment_state(customers_mart, as_of)
    if history is None:
        return start_history(current, KEY, as_of)
    return apply_history(history, current, KEY, CHECKED, as_of, close_missing)


def snapshot_customer_segments(spark: SparkSession, root: str, customers_mart: DataFrame, as_of: datetime,
                               close_missing: bool = True) -> DataFrame:
    """One scheduled run over the history stored at ``root``; returns what changed."""
    return run_history(spark, root, segment_state(customers_mart, as_of), KEY, CHECKED, as_of, close_missing)


def customer_segment_history(spark: SparkSession, root: str) -> DataFrame:
    return read_history(spark, root)
