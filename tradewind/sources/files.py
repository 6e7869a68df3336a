"""Reading Parquet: dated partitions, all files below a folder, the newest file."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def list_files(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """Path, modification time and size of the data files below ``root``.

    The content column is pruned, so no file is opened. Names that begin with ``_`` or ``.``
    (transaction logs, commit markers) are skipped by Spark.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
        .load(root)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    )


def read_files(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Union of Parquet files by column name; an error when there are none.

    Without ``schema`` the schemas of all files are merged, which reads every footer; pass one for
    large folders.
    """
    if not paths or (isinstance(paths, str) and list_files(spark, paths).isEmpty()):
        raise FileNotFoundError(f"no Parquet files to read: {paths}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def read_partition(spark: SparkSession, base: str, run_date: str) -> DataFrame:
    """Rows of one dated load; only its folder is scanned."""
    return spark.read.parquet(base).where(F.col("run_date") == F.lit(run_date).cast("date"))


def newest_file(files: DataFrame) -> str | None:
    """Path of the most recently modified file, the greatest path among equals."""
    row = files.agg(F.max(F.struct("modified", "path")).alias("latest")).first()
    return row["latest"]["path"] if row["latest"] else None


def _plain(path: str) -> str:
    """A path without scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def read_newest(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """All rows of the newest extract below ``root``: the files of the folder that holds the newest file.
    A file that lies in ``root`` itself is an extract of its own."""
    path = newest_file(list_files(spark, root))
    if path is None:
        raise FileNotFoundError(f"no Parquet files below {root}")
    folder = path.rsplit("/", 1)[0]
    return read_files(spark, path if _plain(folder) == _plain(root) else folder, schema)
