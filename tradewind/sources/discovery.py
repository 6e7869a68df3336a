"""Files that appeared below a folder since the last look, as a stream with a checkpoint.

The checkpoint is the set of files already seen, so a run compares nothing with a manifest, and what is new comes in
parts of a bounded number of files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

FOUND = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, root: str, per_part: int, suffix: str = ".parquet") -> DataFrame:
    """A stream of path, modified and bytes. Names that begin with ``_`` or ``.`` are skipped by Spark; files may be
    of any age. The content column is pruned, so no file is opened."""
    return (
        spark.readStream.format("binaryFile").schema(FOUND)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
        .option("maxFilesPerTrigger", per_part).option("maxFileAge", "36500d")
        .load(root)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    )


def each_part(spark: SparkSession, root: str, checkpoint: str, per_part: int,
              take: Callable[[DataFrame, int], None], suffix: str = ".parquet") -> None:
    """Call ``take`` with the files and the number of each part until nothing new is left. A part whose ``take``
    did not return is given again with the same files and number."""
    query = (
        new_files(spark, root, per_part, suffix).writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
