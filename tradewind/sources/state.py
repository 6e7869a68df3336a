"""What earlier runs already loaded: a high-water mark per table, a manifest of files per topic."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

WATERMARK = T.StructType([
    T.StructField("last_extracted_at", T.TimestampType()),
    T.StructField("last_run_at", T.TimestampType()),
    T.StructField("last_row_count", T.LongType()),
    T.StructField("last_path", T.StringType()),
    T.StructField("table_name", T.StringType()),
])
MANIFEST = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("load_id", T.IntegerType()),
])
# Files a discovery has staged, with the columns each one has.
FOUND = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("load_id", T.IntegerType()),
])


def read_state(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The state written so far; an empty table before the first run."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def watermarks(spark: SparkSession, folder: str) -> DataFrame:
    """One row per table."""
    return read_state(spark, folder, WATERMARK)


def last_extracted(spark: SparkSession, folder: str, table: str) -> datetime | None:
    row = watermarks(spark, folder).where(F.col("table_name") == table).first()
    return row["last_extracted_at"] if row else None


def watermark_of(extract: DataFrame, table: str, column: str | None, run_time: datetime, path: str) -> DataFrame:
    """The state row an extract leads to; tables always read in full have no high-water mark."""
    mark = F.max(column).cast("timestamp") if column else F.lit(None).cast("timestamp")
    return extract.agg(mark.alias("last_extracted_at"), F.count("*").alias("last_row_count")).select(
        "last_extracted_at", F.lit(run_time).cast("timestamp").alias("last_run_at"), "last_row_count",
        F.lit(path).alias("last_path"), F.lit(table).alias("table_name"),
    )


def advance(spark: SparkSession, folder: str, mark: DataFrame) -> None:
    """Replace the state row of the tables in ``mark``; the others stay."""
    (
        mark.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_name").parquet(folder)
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Files loaded so far and the load each one belongs to."""
    return read_state(spark, folder, MANIFEST)


def pending(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files that no earlier load has taken."""
    return files.join(loaded.select("path").distinct(), "path", "left_anti")


def extended(loaded: DataFrame, added: DataFrame) -> DataFrame:
    """The set of loaded paths with the added ones."""
    return loaded.select("path").union(added.select("path")).distinct()


def next_load(loaded: DataFrame) -> int:
    """Number of the load to come. It depends on completed loads only, so a load that died half-way
    is repeated under the same number and replaces what it left behind."""
    row = loaded.agg(F.max("load_id").alias("last")).first()
    return 0 if row["last"] is None else row["last"] + 1


def mark_loaded(paths: DataFrame, folder: str, load_id: int) -> None:
    (
        paths.select("path", F.lit(load_id).alias("load_id"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(folder)
    )
