"""The daily load of a batch table: extract, land, gate, load, reconcile."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tradewind.operators.aggregates import reconcile, row_counts
from tradewind.operators.dedup import INGESTED
from tradewind.operators.quality import Check, evaluate, require
from tradewind.sources import sinks, state
from tradewind.sources.extract import since
from tradewind.sources.files import read_partition

Reader = Callable[[], DataFrame]


@dataclass(frozen=True)
class Layout:
    """Folders of one table: landed files, loaded table, and the shared extraction state."""

    landing: str
    table: str
    state: str


def extract_increment(spark: SparkSession, rows: DataFrame, name: str, column: str | None,
                      layout: Layout, run_time: datetime) -> bool:
    """Land what is new since the last run and remember how far it got; False when nothing was.

    The mark is read back from the landed rows, so it never runs ahead of what was written, and
    only moves after the write: a run that dies in between is simply repeated.
    """
    last = state.last_extracted(spark, layout.state, name) if column else None
    folder = f"{layout.landing}/run={run_time:%Y%m%d_%H%M%S}"
    fresh = since(rows, column, last) if column else rows
    if fresh.isEmpty():
        return False
    sinks.write_parquet(fresh, folder)
    state.advance(spark, layout.state,
                  state.watermark_of(spark.read.parquet(folder), name, column, run_time, folder))
    return True


def load_dated(spark: SparkSession, rows: DataFrame, name: str, layout: Layout, run_date: date,
               checks: Sequence[Check] = (), loaded_at: datetime | None = None,
               schema: StructType | None = None) -> DataFrame:
    """Land a dated extract, check the landed rows, load them; returns the loaded partition.

    With ``schema`` the landed columns are matched by name to those of the table, so that drift of the
    source does not reach it. A failed check raises before the table is touched. Repeating the date
    replaces its rows.
    """
    sinks.write_dated(rows, layout.landing, run_date)
    landed = read_partition(spark, layout.landing, f"{run_date}").drop("run_date")
    if checks:
        require(evaluate(landed, name, checks), name)
    if schema is not None:
        landed = sinks.align(landed, schema)
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    sinks.replace_partition(landed.withColumn(INGESTED, stamp), layout.table, "load_date", run_date)
    return spark.read.parquet(layout.table).where(F.col("load_date") == F.lit(run_date))


def reconcile_load(sources: dict[str, DataFrame], targets: dict[str, DataFrame],
                   tolerance: float = 0.01) -> DataFrame:
    """Row counts of the extracts against the rows loaded for the same date."""
    return reconcile(row_counts(sources), row_counts(targets), tolerance)


class RowCountMismatch(RuntimeError):
    """A table was loaded with too few or too many rows."""


def require_reconciled(result: DataFrame) -> None:
    """Stop the run if any table of a ``reconcile_load`` result (one row per table) is out of tolerance."""
    off = result.where(~F.col("within_tolerance")).orderBy("table_name").collect()
    if off:
        raise RowCountMismatch(", ".join(
            f"{row['table_name']}: {row['target_count']} of {row['source_count']} rows" for row in off))
