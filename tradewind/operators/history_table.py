"""Type-2 history kept in partitions: a run writes what it changes and leaves all other files alone.

Below the root lie three tables. ``open`` holds the open versions in a fixed number of buckets by a hash of the
key; a run replaces only the buckets in which a version opens or closes. ``closed`` holds the closed versions, one
partition for each run that closed any, and is never read by a run. ``changes`` holds what a run found, one
partition a run; the join of open versions with current rows is computed once, for it.

A run that dies is repeated with the same time: it finds again what is not yet applied, and keeps what it had
already closed, unless that version is still open.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.operators.history import SPAN_COLUMNS, start_history

BUCKETS = 64  # of the open versions; fixed for the life of a table
BUCKET, RUN, OUTCOME = "_bucket", "_run", "_outcome"


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None before anything was written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _replace(rows: DataFrame, path: str, column: str) -> None:
    """Replaces the partitions that occur in ``rows``; each is one file, or several where it is large."""
    (
        rows.hint("rebalance", F.col(column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy(column).parquet(path)
    )


def matched(open_versions: DataFrame, current: DataFrame, key: str, check: Sequence[str]) -> DataFrame:
    """Keys whose open version and current row do not agree: ``_outcome`` is changed, new or missing; ``old`` and
    ``new`` are the two rows as structs."""
    old = open_versions.select(F.struct("*").alias("old"))
    new = current.select(F.struct("*").alias("new"))
    paired = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    differs = F.lit(False)
    for name in check:
        differs = differs | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    outcome = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "missing").when(differs, "changed")
    return paired.withColumn(OUTCOME, outcome).where(F.col(OUTCOME).isNotNull())


def run_history(spark: SparkSession, root: str, current: DataFrame, key: str, check: Sequence[str], as_of: datetime,
                close_missing: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """One run at ``as_of``; returns its changes (``_outcome``, ``old``, ``new``). ``current`` is unique on the key.

    Rows with a NULL key take no part. An empty ``current`` closes all versions, unless ``close_missing`` is off.
    """
    run = f"{as_of:%Y%m%dT%H%M%S%f}"
    current = current.where(F.col(key).isNotNull())
    fresh = start_history(current, key, as_of)
    before = _stored(spark, f"{root}/open")
    starting = before is None
    if starting:  # all rows are open versions
        _replace(fresh.withColumn(BUCKET, _bucket(key, buckets)), f"{root}/open", BUCKET)
        before = fresh.limit(0).withColumn(BUCKET, F.lit(0))
    versions = [*current.columns, *SPAN_COLUMNS]
    found = matched(before.select(*versions), fresh.select(*versions), key, check)
    if not close_missing:
        found = found.where(F.col(OUTCOME) != "missing")
    place = _bucket("_key", buckets).alias(BUCKET)
    changes = found.withColumn("_key", F.coalesce(F.col(f"old.{key}"), F.col(f"new.{key}"))).select("*", place)
    if starting:
        return changes
    _replace(changes.withColumn(RUN, F.lit(run)), f"{root}/changes", RUN)
    applied = _stored(spark, f"{root}/changes")
    if applied is None:
        return changes
    applied = applied.where(F.col(RUN) == run).drop(RUN)

    now = F.lit(as_of).cast("timestamp")
    closing = applied.where(F.col("old").isNotNull()).select("old.*").withColumn("valid_to", now)
    earlier = _stored(spark, f"{root}/closed")
    if earlier is not None:  # what this run closed before it died
        kept = earlier.where(F.col(RUN) == run).select(*versions)
        staying = before.join(closing, "scd_id", "left_anti").select("scd_id")
        again = kept.join(closing, "scd_id", "left_anti").join(staying, "scd_id", "left_anti").select(*versions)
        closing = closing.unionByName(again)
    if not closing.isEmpty():
        _replace(closing.select(*versions).withColumn(RUN, F.lit(run)), f"{root}/closed", RUN)

    touched = [row[BUCKET] for row in applied.select(BUCKET).distinct().collect()]  # at most ``buckets``
    if touched:
        staying = before.where(F.col(BUCKET).isin(touched)).join(
            applied.select(F.col("_key").alias(key)), key, "left_anti").select(*versions)
        opened = applied.where(F.col("new").isNotNull()).select("new.*").select(*versions)
        after = staying.unionByName(opened).withColumn(BUCKET, _bucket(key, buckets))
        held = {row[BUCKET] for row in after.select(BUCKET).distinct().collect()}
        _replace(after, f"{root}/open", BUCKET)
        for number in sorted(set(touched) - held):  # nothing is left to swap in: an empty bucket takes the place
            fresh.limit(0).select(*versions).coalesce(1).write.mode("overwrite").parquet(f"{root}/open/{BUCKET}={number}")
    return applied


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All versions, open and closed."""
    current = spark.read.parquet(f"{root}/open").drop(BUCKET)
    settled = _stored(spark, f"{root}/closed")
    return current if settled is None else current.unionByName(settled.drop(RUN))
