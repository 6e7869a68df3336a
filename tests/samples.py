"""Hand-made rows in the shape of the raw tables. Anything not given is NULL."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

from tradewind.sources.registry import SOURCES

LOADED = datetime(2024, 3, 1)


def raw(spark, name, *rows, text=()):
    """A raw table from dicts; columns named in ``text`` are kept as text."""
    fields = [
        T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in SOURCES[name].schema.fields
    ]

    def value(row, field):
        got = row.get(field.name, LOADED if field.name == "_ingested_at" else None)
        if got is not None and isinstance(field.dataType, T.DecimalType):
            return Decimal(str(got))
        return got

    return spark.createDataFrame([tuple(value(row, f) for f in fields) for row in rows], T.StructType(fields))


ORDER_TIMES = ("order_date", "shipped_date", "delivered_date", "created_at")


def orders(spark, *rows):
    """Orders with ISO text times."""
    filled = [{"created_at": row.get("order_date"), **row} for row in rows]
    return raw(spark, "orders_history", *filled, text=ORDER_TIMES)


def by(key, frame):
    """Rows by key."""
    return {row[key]: row for row in frame.collect()}
