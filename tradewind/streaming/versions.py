"""Earlier versions of a landed table and an audit of its current one.

A Delta table keeps versions itself. A Parquet table written per batch number has them as well:
version n is everything up to batch n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.streaming.gate import BATCH


def read_current(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.format(format).load(path)


def read_version(spark: SparkSession, path: str, version: int, format: str = "parquet") -> DataFrame:
    if format == "delta":
        return spark.read.format(format).option("versionAsOf", version).load(path)
    return read_current(spark, path, format).where(F.col(BATCH) <= version)


def version_counts(spark: SparkSession, path: str, versions: list[int], format: str = "parquet") -> DataFrame:
    """Rows of the given versions, rows now, and rows added since; one row per version.

    Versions by batch number are counted in one scan of the table, which reads no column but the batch number. A Delta
    table has each version in files of its own, so each is scanned.
    """
    versions = list(dict.fromkeys(versions))
    table = read_current(spark, path, format)
    if format == "delta":
        rows = table.agg(F.count("*").alias("rows")).withColumn("version", F.lit(None).cast("int"))
        for version in versions:
            then = read_version(spark, path, version, format).agg(F.count("*").alias("rows"))
            rows = rows.unionByName(then.withColumn("version", F.lit(version)))
        counts = rows.agg(F.max(F.when(F.col("version").isNull(), F.col("rows"))).alias("current_rows"),
                          *[F.max(F.when(F.col("version") == version, F.col("rows"))).alias(f"_{version}")
                            for version in versions])
    else:
        counts = table.agg(F.count("*").alias("current_rows"),
                           *[F.count_if(F.col(BATCH) <= version).alias(f"_{version}") for version in versions])
    measured = F.array(*[F.struct(F.lit(version).alias("version"), F.col(f"_{version}").alias("version_rows"))
                         for version in versions])
    return counts.select(F.explode(measured).alias("of"), "current_rows").select(
        "of.version", "of.version_rows", "current_rows",
        (F.col("current_rows") - F.col("of.version_rows")).alias("rows_added"))


def audit(table: DataFrame, name: str) -> DataFrame:
    """One row: number of rows, of columns, and the schema."""
    return table.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count",
        F.lit(len(table.columns)).alias("column_count"),
        F.lit(table.schema.simpleString()).alias("schema_text"),
    )
