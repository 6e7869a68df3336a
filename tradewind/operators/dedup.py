"""Keep one version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

INGESTED = "_ingested_at"


def first_per_key(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of every key in the given order.

    Spark turns the filter into a per-task limit ahead of the shuffle, so a key that fills a third
    of the table sends one row per task instead of all its rows.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def keep_latest(rows: DataFrame, key: str, recency: str = INGESTED,
                ties: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the most recently loaded.

    Rows of equal recency are ranked by ``ties``, by default all other columns, so a recomputed
    task always picks the same row. Pass fewer columns when a load cannot repeat a key; then the
    scan is pruned to what the caller selects.
    """
    if ties is None:
        ties = [name for name in rows.columns if name not in (key, recency)]
    order = [F.col(name).desc_nulls_last() for name in (recency, *ties)]
    return first_per_key(rows, [key], *order)
