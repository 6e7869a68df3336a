"""Staged publishing: rows are written beside the table, judged there, and moved in as whole partitions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.operators.quality import Check, evaluate, require
from tradewind.session import shuffles_removed
from tradewind.sources import sinks


@dataclass(frozen=True)
class Staging:
    """Folders: staged rows, the table, and the results of the checks of the last attempt."""

    staged: str
    table: str
    results: str


def stage(rows: DataFrame, where: Staging, column: str, value) -> None:
    """Write the rows as one partition beside the table; a repeated run replaces it."""
    sinks.replace_partition(rows, where.staged, column, value)


def staged_rows(spark: SparkSession, where: Staging, column: str, values: Sequence) -> DataFrame:
    """The staged partitions. Their column has the type that Spark reads from the path."""
    return spark.read.parquet(where.staged).where(F.col(column).cast("string").isin([str(value) for value in values]))


def publish(spark: SparkSession, name: str, where: Staging, column: str, values: Sequence,
            checks: Sequence[Check] = (), parents: Mapping[str, DataFrame] | None = None,
            judged: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Judge the staged partitions together and move them into the table by one partition overwrite.

    The results are written whatever they are. If a check fails, ``QualityError`` is raised, the table is not touched
    and the rows stay staged. ``judged`` gives the rows the shape the checks expect. A run that dies half-way is
    repeated: it replaces the same partitions. So staged rows are cleared only once the caller has noted the load.
    """
    with shuffles_removed(spark):
        rows = staged_rows(spark, where, column, values)
        if checks:
            evaluate(judged(rows.drop(column)), name, checks, parents).write.mode("overwrite").parquet(where.results)
            require(spark.read.parquet(where.results), name)
        held = {row[0] for row in rows.select(F.col(column).cast("string")).distinct().collect()}  # of a few values
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
            .partitionBy(column).parquet(where.table)
        )
        for value in values:
            if str(value) not in held:  # an empty load
                sinks.replace_partition(rows.drop(column).limit(0), where.table, column, value)


def clear(spark: SparkSession, where: Staging, column: str, values: Sequence) -> None:
    """Empty the staged partitions."""
    rows = spark.read.parquet(where.staged).drop(column).limit(0)
    for value in values:
        sinks.replace_partition(rows, where.staged, column, value)
