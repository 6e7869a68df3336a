"""Slowly-changing history (type 2): every version of a key with the time span it was valid."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

SPAN_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def _scd_id(key: str, as_of: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), as_of.cast("string")))


def start_history(current: DataFrame, key: str, as_of: datetime) -> DataFrame:
    """First version of every key."""
    now = F.lit(as_of).cast("timestamp")
    return current.select(
        "*",
        _scd_id(key, now).alias("scd_id"),
        now.alias("updated_at"),
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def history_changes(history: DataFrame, current: DataFrame, key: str, check: Sequence[str],
                    as_of: datetime, close_missing: bool = True) -> DataFrame:
    """All open versions after the run plus the versions this run closes.

    One full outer join of the open versions with the current rows; each pair yields one row
    (unchanged, new, or gone) or two (closed old and opened new version). Versions closed by
    earlier runs are not read: they can stay untouched where they are stored.
    """
    now = F.lit(as_of).cast("timestamp")
    version = [*current.columns, *SPAN_COLUMNS]
    old = history.where(F.col("valid_to").isNull()).select(F.struct(*version).alias("old"))
    new = start_history(current, key, as_of).select(F.struct(*version).alias("new"))
    paired = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    changed = F.lit(False)
    for name in check:
        changed = changed | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    closed = F.col("old").withField("valid_to", now)
    gone = closed if close_missing else F.col("old")
    versions = (
        F.when(F.col(f"old.{key}").isNull(), F.array(F.col("new")))
        .when(F.col(f"new.{key}").isNull(), F.array(gone))
        .when(changed, F.array(closed, F.col("new")))
        .otherwise(F.array(F.col("old")))
    )
    return paired.select(F.explode(versions).alias("version")).select("version.*")


def apply_history(history: DataFrame, current: DataFrame, key: str, check: Sequence[str],
                  as_of: datetime, close_missing: bool = True) -> DataFrame:
    """The whole history after the run; running it again with the same rows changes nothing."""
    changes = history_changes(history, current, key, check, as_of, close_missing)
    settled = history.where(F.col("valid_to").isNotNull()).select(*changes.columns)
    return settled.unionByName(changes)
