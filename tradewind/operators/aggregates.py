"""Aggregation patterns beyond the built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def commonest(value: str, weight: str) -> Column:
    """Value with the largest weight, the smallest value on a tie; NULL values do not compete.

    For rows already counted per value. Unlike ``mode`` it holds one candidate per group, not a
    map of all values, so the number of distinct values in a group does not matter.
    """
    ranking = F.when(F.col(value).isNotNull(), F.struct(-F.col(weight), F.col(value)))
    return F.min_by(F.col(value), ranking)


def most_frequent(rows: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Most frequent value per group, in two shuffles that both combine before sending."""
    counted = rows.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(commonest(value, "_n").alias(alias))


def distinct_counts(rows: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Distinct non-null values of several columns (output name -> column) per group.

    Each column is counted on its own, from a scan of the key and that column, in two steps that
    combine before they shuffle. One aggregation for all would send every row once per column.
    """
    counted = None
    for alias, name in columns.items():
        part = rows.select(key, name).distinct().groupBy(key).agg(F.count(name).alias(alias))
        counted = part if counted is None else counted.unionByName(part, allowMissingColumns=True)
    return counted.groupBy(key).agg(*[F.sum(alias).alias(alias) for alias in columns])


def first_by(value: Column, *order: Column) -> Column:
    """Value of the row that comes first; further order columns break ties."""
    return F.min_by(value, F.struct(*order))


def last_by(value: Column, *order: Column) -> Column:
    return F.max_by(value, F.struct(*order))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionAll(part)
    return result


def reconcile(source_counts: DataFrame, target_counts: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Compare row counts per table; an empty source is not judged.

    Both inputs are ``row_counts`` results, one row per table.
    """
    source = source_counts.select("table_name", F.col("row_count").alias("source_count"))
    target = target_counts.select("table_name", F.col("row_count").alias("target_count"))
    difference = F.abs(F.col("source_count") - F.coalesce(F.col("target_count"), F.lit(0)))
    ratio = F.when(F.col("source_count") > 0, difference / F.col("source_count"))
    return (
        source.join(target, "table_name", "left")
        .withColumn("difference_ratio", ratio)
        .withColumn("within_tolerance", F.coalesce(F.col("difference_ratio") <= tolerance, F.lit(True)))
    )
