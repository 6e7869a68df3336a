"""Reading operational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tradewind.sources.extract import since

# Tables that can be read incrementally and the column that orders their rows.
INCREMENTAL_COLUMNS = {
    "customers": "created_at",
    "suppliers": "created_at",
    "products": "created_at",
    "orders_history": "created_at",
}


PARTS = 16  # connections side by side, unless told otherwise


def bounds_of(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], column: str) -> tuple[str, str] | None:
    """Least and greatest value of a column, found by the database; None without values."""
    question = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=question, **properties).load().first()
    return None if row is None or row["low"] is None else (str(row["low"]), str(row["high"]))


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
               column: str | None = None, bounds: tuple[str, str] | None = None, parts: int = PARTS,
               ranges: Sequence[str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Whole table, in ranges side by side.

    ``ranges`` are conditions such as ``plan_ranges`` makes from the last extract; they fit a skewed column. Otherwise
    ``column``, by default the one that orders the table's rows, is cut into ``parts`` equal ranges between ``bounds``,
    which the database is asked for where they are not given. Bounds only place the cuts: rows beyond them and rows
    without a value are read as well. A table without such a column is read over one connection.
    """
    properties = {"fetchsize": str(fetch_size), **properties}
    if ranges:
        return spark.read.jdbc(url, table, predicates=list(ranges), properties=properties)
    options = {"url": url, "dbtable": table, **properties}
    column = column or INCREMENTAL_COLUMNS.get(table.rsplit(".", 1)[-1])
    if column and parts > 1:
        bounds = bounds or bounds_of(spark, url, table, properties, column)
        if bounds:
            options |= {"partitionColumn": column, "lowerBound": bounds[0], "upperBound": bounds[1],
                        "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**options).load()


def read_increment(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
                   last: datetime | None, **reading) -> DataFrame:
    """Rows newer than the last extract; Spark sends the condition to the database."""
    return since(read_table(spark, url, table, properties, **reading), INCREMENTAL_COLUMNS[table], last)
