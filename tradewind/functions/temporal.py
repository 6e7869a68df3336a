"""Timestamps: tolerant parsing, calendar columns, boundary-counting differences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ssxxx"


def parse_time(name: str) -> Column:
    """Text to timestamp; anything unreadable becomes NULL instead of an error. A column that is a
    timestamp already stays as it is, so filters on it still reach the scan."""
    return F.col(name).try_cast("timestamp")


def iso_text(time: Column) -> Column:
    """ISO-8601 with seconds and a ``+HH:MM`` offset."""
    return F.date_format(time, ISO_PATTERN)


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights crossed from ``start`` to ``end``."""
    return F.datediff(end, start).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Number of whole-second boundaries crossed from ``start`` to ``end``."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def order_calendar(time: Column) -> dict[str, Column]:
    """Calendar columns of an order; weeks start on Monday, weekdays count from Sunday = 1."""
    return {
        "order_date_day": F.to_date(time),
        "order_week": F.date_trunc("week", time),
        "order_month": F.date_trunc("month", time),
        "order_year": F.year(time),
        "order_month_num": F.month(time),
        "order_day_of_week": F.dayofweek(time),
    }


def date_spine(time: Column) -> dict[str, Column]:
    """The nine calendar columns of a date spine."""
    return {
        "date_day": F.to_date(time),
        "date_week": F.date_trunc("week", time),
        "date_month": F.date_trunc("month", time),
        "date_year": F.date_trunc("year", time),
        "year_num": F.year(time),
        "month_num": F.month(time),
        "day_num": F.dayofmonth(time),
        "day_of_week": F.dayofweek(time),
        "day_name": F.date_format(time, "EEEE"),
    }


def hour_partitions(time: Column) -> dict[str, Column]:
    """Partition columns of a landed event."""
    return {
        "year": F.year(time),
        "month": F.month(time),
        "day": F.dayofmonth(time),
        "hour": F.hour(time),
    }
