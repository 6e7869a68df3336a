"""Session settings the plans rely on, and the shared folder used for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings. Day boundaries are defined in UTC, so the time zone is part of the
# semantics. The skew settings let AQE split a hot join key even when an aggregation on the same
# key follows; the price is an extra shuffle, paid only when a skewed partition is really found.
# Shuffles start with many partitions, of which AQE joins small ones: what a task sorts and holds
# does not grow with the tables, whatever the number set for the session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; sizing is left to the cluster."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tradewind", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


# Shuffle files of a finished write are of no use: its result is in the table.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written here takes its shuffle files off the disk when it ends. Otherwise they stay until the driver
    happens to collect its garbage, so that a job of many writes holds those of all."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``, else one
    beside the session's tables."""
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared")
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the shared root."""
    return f"{shared_root(spark)}/tradewind/{purpose}-{uuid.uuid4().hex}"
