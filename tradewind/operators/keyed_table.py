"""A table with one row per key that takes batches: a batch rewrites only the parts of the table it changes.

Rows lie in a fixed number of buckets by a hash of the key. A batch is reduced to one row per key and stored; it
meets only the rows of its own buckets; what it really changes is stored, and the buckets that hold a change are
replaced by one partition overwrite. All other files stay as they are, and the history of loads is never ranked again.

Every change is repeatable: a batch that died half-way is given again under the same name, finds what is not yet
applied and leaves the rest. Rows with a NULL key take no part. Below the root lie ``rows`` (the table), ``layout``
(key and number of buckets, fixed with the first batch), and ``batches`` and ``changes`` with a folder per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.operators.dedup import INGESTED, first_per_key

BUCKET = "_bucket"
BUCKETS = 64  # choose more for a large table, so that a bucket holds about a gigabyte


class KeyedTable:
    """The table below ``root``. ``buckets`` counts for a new table only; an old one keeps its own number."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key = spark, root, key
        known = self._read("layout")
        if known is None:
            spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.parquet(f"{root}/layout")
        else:
            first = known.first()
            if first["key"] != key:
                raise ValueError(f"{root} is kept by {first['key']}, not by {key}")
            buckets = first["buckets"]
        self.buckets = buckets

    def rows(self) -> DataFrame:
        """The table as it is now; an error before the first batch."""
        return self.spark.read.parquet(f"{self.root}/rows").drop(BUCKET)

    def merge_latest(self, load: DataFrame, name: str, recency: str = INGESTED, ties: Sequence[str] | None = None) -> DataFrame:
        """Keeps the most recent row of each key, whatever the order in which loads arrive; returns the changes.

        Rows of equal recency are ranked by ``ties``, by default all other columns in the order of the first load.
        The result equals ``keep_latest`` over all loads together.
        """
        stored = self._stored(load)
        columns = load.columns if stored is None else stored.drop(BUCKET).columns
        if ties is None:
            ties = [column for column in columns if column not in (self.key, recency)]
        order = [recency, *ties]
        newest = first_per_key(self._keyed(load), [self.key], *[F.col(column).desc_nulls_last() for column in order])

        def rank(side: str) -> Column:  # NULL is the smallest value of a field, so it comes last
            return F.struct(*[F.col(f"{side}.{column}") for column in order])

        return self._take(newest, name, lambda old, new: rank(new) > rank(old), F.col("new"))

    def insert_absent(self, rows: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
        """Adds rows whose key the table does not have, of equal keys the first in ``order``; returns them."""
        single = first_per_key(self._keyed(rows), [self.key], *[F.col(column).asc_nulls_last() for column in order])
        return self._take(single, name, lambda old, new: F.lit(False), F.col("new"))

    def update(self, changes: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
        """Replaces the columns ``values`` of the rows whose key ``changes`` has (unique there); returns the rows that
        get another value. Keys the table does not have are left out."""
        schema = self.rows().schema
        side = changes.select(self.key, *[F.col(column).cast(schema[column].dataType) for column in values])

        def differs(old: str, new: str) -> Column:
            found = F.lit(False)
            for column in values:
                found = found | ~F.col(f"{old}.{column}").eqNullSafe(F.col(f"{new}.{column}"))
            return found

        merged = F.struct(*[F.col(f"{'new' if column in values else 'old'}.{column}").alias(column) for column in schema.names
                            if column != BUCKET])
        return self._take(self._keyed(side), name, differs, merged, adding=False)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col(self.key).isNotNull())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _read(self, part: str) -> DataFrame | None:
        """A part of the table; None before anything was written there."""
        try:
            return self.spark.read.parquet(f"{self.root}/{part}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _stored(self, load: DataFrame) -> DataFrame | None:
        stored = self._read("rows")
        if stored is not None and {*load.columns} != {*stored.columns} - {BUCKET}:
            raise ValueError(f"columns {load.columns} do not fit {stored.drop(BUCKET).columns}")
        return stored

    def _kept(self, rows: DataFrame, part: str) -> DataFrame:
        """Rows written to a folder of their own, with a file and a schema even if there are none."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{part}")
        return self.spark.read.parquet(f"{self.root}/{part}")

    def _touched(self, rows: DataFrame) -> list[int]:
        """Bucket numbers on the driver: at most ``buckets``."""
        return [row[BUCKET] for row in rows.select(BUCKET).distinct().collect()]

    def _take(self, single: DataFrame, name: str, wins: Callable[[str, str], Column], merged: Column,
              adding: bool = True) -> DataFrame:
        """Applies a batch that is unique on the key."""
        batch = self._kept(single.withColumn(BUCKET, self._bucket()), f"batches/{name}")
        stored = self._read("rows")
        if stored is None:
            self._replace(batch)
            return self._kept(batch, f"changes/{name}").drop(BUCKET)
        columns = stored.drop(BUCKET).columns
        near = stored.where(F.col(BUCKET).isin(self._touched(batch)))
        new, old = batch.select(F.struct("*").alias("new")), near.select(F.struct("*").alias("old"))
        paired = new.join(old, F.col(f"new.{self.key}") == F.col(f"old.{self.key}"), "left" if adding else "inner")
        won = F.col("old").isNull() | wins("old", "new")
        found = paired.where(won).select(merged.alias("row"), F.col(f"new.{BUCKET}").alias(BUCKET))
        changes = self._kept(found.select(*[F.col(f"row.{column}").alias(column) for column in columns], BUCKET), f"changes/{name}")
        touched = self._touched(changes)
        if touched:
            staying = stored.where(F.col(BUCKET).isin(touched)).join(changes.select(self.key), self.key, "left_anti")
            self._replace(staying.select(*columns, BUCKET).unionByName(changes))
        return changes.drop(BUCKET)

    def _replace(self, rows: DataFrame) -> None:
        """Replaces the buckets that occur in ``rows``; each is one file, or several where it is large."""
        (
            rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
            .partitionBy(BUCKET).parquet(f"{self.root}/rows")
        )
