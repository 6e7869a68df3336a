"""Ranges in which a table is read side by side, planned from how the values of a column lie.

Cuts are quantiles of the column, taken from values that occur, so no range is empty and a skewed column gives ranges
of about equal size. They can come from any copy of the column, such as the last extract that was landed, which a
cluster reads in parallel: the ranges cover all values and NULL, also those the copy does not have.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

ACCURACY = 10_000  # of the quantiles: a rank is off by at most 1 / ACCURACY of the rows
ORDERED = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType)


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, Decimal):
        return f"{value:f}"
    return str(int(value))


def _checked(rows: DataFrame, column: str) -> None:
    if not column.isidentifier():
        raise ValueError(f"{column!r} cannot stand in a condition")
    if not isinstance(rows.schema[column].dataType, ORDERED):
        raise ValueError(f"{column} is {rows.schema[column].dataType.simpleString()}: ranges need whole numbers, "
                         f"decimals, dates or times")


def _quantiles(column: str, parts: int) -> Column:
    return F.percentile_approx(column, [n / parts for n in range(1, parts)], ACCURACY)


def _between(column: str, cuts: list) -> list[str]:
    """Conditions of the ranges before, between and after the cuts, each cut the first value of a range."""
    if not cuts:
        return ["1 = 1"]
    marks = [f"{column} >= {_literal(cut)}" for cut in cuts]
    ends = [f"{column} < {_literal(cut)}" for cut in cuts]
    inner = [f"{start} AND {end}" for start, end in zip(marks, ends[1:])]
    return [f"({ends[0]} OR {column} IS NULL)", *inner, marks[-1]]


def plan_ranges(rows: DataFrame, column: str, parts: int, tie: str | None = None) -> list[str]:
    """Conditions in plain SQL, of which every row meets exactly one; at most about ``parts``.

    A value that fills more than a range of its own is a range of its own; with ``tie`` it is cut again by the
    quantiles of that column within it (a value of both columns together is not cut any further). NULL belongs to the
    first range, or to one of its own where it fills that. A table without rows or values is one range.
    """
    _checked(rows, column)
    if tie is not None:
        _checked(rows, tie)
    if parts < 2:
        return ["1 = 1"]
    seen = rows.agg(_quantiles(column, parts).alias("cuts"), F.min(column).alias("least"),
                    F.count(column).alias("values"), F.count(F.lit(1)).alias("rows")).first()
    if not seen["values"]:
        return ["1 = 1"]
    drawn = seen["cuts"]
    hot = sorted({value for n, value in enumerate(drawn) if value in drawn[:n]})
    starts = {value for value in drawn if value > seen["least"]}
    if hot:  # a hot value begins a range, and so does the value after it; fewer than ``parts`` aggregates
        after = rows.agg(*[F.min(F.when(F.col(column) > F.lit(value), F.col(column))).alias(f"after_{n}")
                           for n, value in enumerate(hot)]).first()
        starts |= {value for value in after if value is not None}
    conditions = _between(column, sorted(starts))
    if (seen["rows"] - seen["values"]) * parts >= seen["rows"]:  # NULL is hot
        without = f"{column} IS NOT NULL" if not starts else f"{column} < {_literal(min(starts))}"
        conditions = [f"{column} IS NULL", without, *conditions[1:]]
    if tie is None or not hot:
        return conditions

    # Quantiles of the tie for all hot values in one pass.
    within = {row["value"]: row for row in rows.where(F.col(column).isin(hot)).groupBy(F.col(column).alias("value")).agg(
        _quantiles(tie, parts).alias("cuts"), F.min(tie).alias("least"), F.count(F.lit(1)).alias("rows")).collect()}
    result = []
    for condition, first in zip(conditions, [*[None] * (len(conditions) - len(starts)), *sorted(starts)]):
        value = seen["least"] if first is None else first
        if value not in within or condition.endswith(f"{column} IS NULL") and not condition.startswith("("):
            result.append(condition)
            continue
        row = within[value]
        share = max(1, min(parts, round(row["rows"] * parts / seen["values"])))
        drawn = row["cuts"] or []
        chosen = {drawn[n * parts // share - 1] for n in range(1, share)} if drawn else set()
        cuts = sorted(cut for cut in chosen if cut > row["least"])
        result += [f"({condition}) AND ({part})" for part in _between(tie, cuts)] if cuts else [condition]
    return result
