"""Incremental extraction and the text form in which extracted rows are landed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from tradewind.functions.temporal import iso_text


def since(rows: DataFrame, column: str, last: datetime | None, inclusive: bool = False) -> DataFrame:
    """Rows after the high-water mark, or all rows when there is none yet.

    Late rows that share the last timestamp are missed by the strict comparison; ``inclusive``
    reads that instant again, to be combined with a key deduplication on load.
    """
    if last is None:
        return rows
    mark = F.lit(last).cast(rows.schema[column].dataType)
    return rows.where(F.col(column) >= mark if inclusive else F.col(column) > mark)


def as_landed(rows: DataFrame) -> DataFrame:
    """Times as ISO-8601 text; other columns keep their type, and NULL stays NULL."""
    return rows.select(*[
        iso_text(F.col(field.name)).alias(field.name) if isinstance(field.dataType, T.TimestampType)
        else F.col(field.name)
        for field in rows.schema.fields
    ])


def as_text(rows: DataFrame) -> DataFrame:
    """Every column as text, times as ISO-8601; NULL stays NULL."""
    landed = as_landed(rows)
    return landed.select(*[F.col(name).cast("string").alias(name) for name in landed.columns])
