"""Top-n, reproducible sampling and newest-of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def top_n(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows in the given order; every task keeps n rows, only those are merged."""
    return rows.orderBy(*order).limit(n)


def sample_n(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows chosen at random, evenly over the keys.

    The draw is a hash of seed and key: the same seed gives the same rows whatever the
    partitioning, also when a lost executor makes Spark compute some of them again.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return top_n(rows.withColumn("_draw", draw), n, F.col("_draw"), F.col(key)).drop("_draw")


def newest(rows: DataFrame, value: str, *recency: str) -> DataFrame:
    """One row with the value of the most recent row."""
    return rows.agg(F.max_by(F.col(value), F.struct(*[F.col(name) for name in recency])).alias(value))
