"""Writing: landing layouts, repeatable loads, name-based alignment and row-wise rejection."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tradewind.functions.temporal import parse_time
from tradewind.session import shuffles_removed


def write_parquet(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("compression", "snappy").parquet(path)


def replace_partition(rows: DataFrame, base: str, column: str, value) -> None:
    """Write the rows as one partition; a repeated run replaces it and leaves the others alone.

    The old partition stays in place until the new one is complete. Without rows there is nothing
    to swap in, so an empty partition is written in its place. Rows are counted by the write itself, so
    that they are computed once.
    """
    written = Observation()
    with shuffles_removed(rows.sparkSession):
        (
            rows.observe(written, F.count(F.lit(1)).alias("rows")).withColumn(column, F.lit(value))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
            .partitionBy(column).parquet(base)
        )
    if not written.get["rows"]:
        rows.sparkSession.createDataFrame([], rows.schema).coalesce(1).write.mode("overwrite").parquet(f"{base}/{column}={value}")


def write_dated(rows: DataFrame, base: str, run_date: date) -> None:
    """Landing layout by logical date: ``run_date=YYYY-MM-DD``."""
    replace_partition(rows, base, "run_date", run_date)


def compact(spark: SparkSession, path: str, target: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Rewrite a partitioned table with few large files. The rebalance hint lets AQE split a
    partition value that holds much and join those that hold little, whatever their number."""
    rows = spark.read.parquet(path)
    balanced = rows.hint("rebalance", *[F.col(name) for name in columns])
    balanced.write.mode(mode).option("compression", "snappy").partitionBy(*columns).parquet(target)


def write_run(rows: DataFrame, base: str, run_time: datetime) -> bool:
    """Landing layout by run time (``year=/month=/day=``), appended; an empty extract writes nothing."""
    if rows.isEmpty():
        return False
    stamped = rows.withColumns({
        "year": F.lit(f"{run_time:%Y}"), "month": F.lit(f"{run_time:%m}"), "day": F.lit(f"{run_time:%d}"),
    })
    stamped.write.mode("append").option("compression", "snappy").partitionBy("year", "month", "day").parquet(base)
    return True


def holds(written: DataFrame, expected_rows: int) -> bool:
    """Whether what was written can be read back in full."""
    return written.count() == expected_rows


def _converted(name: str, kind: T.DataType, strict: bool) -> Column:
    if isinstance(kind, T.TimestampType) and not strict:
        return parse_time(name)
    return F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)


def align(rows: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Columns of ``schema``, matched by name whatever the case; missing ones are NULL.

    ``strict`` fails on a value that does not convert, otherwise it becomes NULL.
    """
    present = {name.lower(): name for name in rows.columns}
    return rows.select(*[
        (_converted(present[field.name.lower()], field.dataType, strict) if field.name.lower() in present
         else F.lit(None).cast(field.dataType)).alias(field.name)
        for field in schema.fields
    ])


def split_loadable(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows whose values all convert to ``schema``, and the rejected rest as it came.

    The rejected rows carry the names of the offending columns in ``_rejected``.
    """
    present = {name.lower(): name for name in rows.columns}
    problems = [
        F.when(F.col(present[f.name.lower()]).isNotNull()
               & _converted(present[f.name.lower()], f.dataType, strict=False).isNull(), f.name)
        for f in schema.fields if f.name.lower() in present
    ]
    judged = rows.withColumn("_rejected", F.concat_ws(",", *problems))
    good = align(judged.where(F.col("_rejected") == "").drop("_rejected"), schema, strict=False)
    return good, judged.where(F.col("_rejected") != "")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 audit: str = "_ingested_at") -> None:
    """Create the target table unless it exists; the audit column defaults to the time of insertion."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{audit}` TIMESTAMP DEFAULT current_timestamp()) "
        f"USING parquet LOCATION '{location}'"
    )


def insert_rows(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Append by name; columns the rows do not have take their default."""
    names, incoming = ", ".join(f"`{name}`" for name in rows.columns), f"incoming_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(incoming)
    try:
        spark.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {incoming}")
    finally:
        spark.catalog.dropTempView(incoming)
