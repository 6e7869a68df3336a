"""Key-wise changes to a table, written as joins: the result is the new state of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradewind.functions import money
from tradewind.operators.dedup import first_per_key


def absent_rows(candidates: DataFrame, target: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Candidates whose key the target does not have yet; of equal keys the first in ``order``."""
    single = first_per_key(candidates, [key], *[F.col(name).asc_nulls_last() for name in order])
    return single.join(target.select(key), key, "left_anti")


def insert_if_absent(target: DataFrame, candidates: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Target plus the candidates with new keys; rows already present stay as they are."""
    return target.unionByName(absent_rows(candidates, target, key, order).select(*target.columns))


def update_from(target: DataFrame, changes: DataFrame, key: str, column: str, new_value: str) -> DataFrame:
    """Replace ``column`` where ``changes`` (unique on the key) has a row; other rows keep theirs."""
    side = changes.select(F.col(key).alias("_key"), F.col(new_value).alias("_new"), F.lit(True).alias("_hit"))
    joined = target.join(side, F.col(key) == F.col("_key"), "left")
    replaced = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    kind = target.schema[column].dataType
    return joined.select(*[
        replaced.cast(kind).alias(name) if name == column else F.col(name) for name in target.columns
    ])


def refresh_order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order totals from the subtotals of their items; orders without items keep their total."""
    totals = items.groupBy("order_id").agg(money.total(F.col("subtotal")).alias("items_total"))
    return update_from(orders, totals, "order_id", "total_amount", "items_total")
