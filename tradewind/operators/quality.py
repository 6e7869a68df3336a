"""Data-quality checks: declared as data, evaluated in one aggregation, reported as a table.

All row-level checks of a suite share one pass over the data. Uniqueness checks add one grouped
pass for all of them together, each referential check one pre-aggregated join. Only the result
table, one row per check, is ever brought to the driver, and only by ``require``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from tradewind.operators.joins import known_key_share

RESULT_COLUMNS = (
    "suite", "position", "check", "column", "element_count", "unexpected_count",
    "unexpected_ratio", "mostly", "success",
)


@dataclass(frozen=True)
class Check:
    kind: str
    column: str = ""
    mostly: float = 1.0
    values: tuple = ()
    low: object = None
    high: object = None
    pattern: str = ""


def column_exists(column: str) -> Check:
    return Check("column_exists", column)


def column_count(number: int) -> Check:
    return Check("column_count", low=number, high=number)


def row_count(low: int | None, high: int | None) -> Check:
    return Check("row_count", low=low, high=high)


def not_null(column: str, mostly: float = 1.0) -> Check:
    return Check("not_null", column, mostly)


def unique(column: str) -> Check:
    """Every row of a repeated value counts as unexpected."""
    return Check("unique", column)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Check:
    return Check("in_set", column, mostly, values=tuple(values))


def between(column: str, low=None, high=None, mostly: float = 1.0) -> Check:
    """Both bounds inclusive; a bound left out does not apply."""
    return Check("between", column, mostly, low=low, high=high)


def matches(column: str, pattern: str, mostly: float = 1.0) -> Check:
    return Check("matches", column, mostly, pattern=pattern)


def references(column: str, parent: str, parent_column: str, mostly: float = 1.0) -> Check:
    """The value occurs in ``parent_column`` of the table given as ``parent``."""
    return Check("references", column, mostly, values=(parent, parent_column))


def _holds(check: Check) -> Column:
    """The condition a non-null value must meet."""
    value = F.col(check.column)
    if check.kind == "in_set":
        return value.isin(*check.values)
    if check.kind == "matches":
        return value.rlike(check.pattern)
    condition = F.lit(True)
    if check.low is not None:
        condition = condition & (value >= F.lit(check.low))
    if check.high is not None:
        condition = condition & (value <= F.lit(check.high))
    return condition


def _within(number: Column, check: Check) -> Column:
    condition = F.lit(True)
    if check.low is not None:
        condition = condition & (number >= check.low)
    if check.high is not None:
        condition = condition & (number <= check.high)
    return condition


def _measures(rows: DataFrame, check: Check) -> tuple[Column, Column]:
    """Aggregates: number of elements judged, number of unexpected ones.

    For checks of the table as a whole the first is the observed number and the second tells
    whether it is wrong.
    """
    everything, zero = F.count(F.lit(1)), F.lit(0).cast("bigint")
    if check.kind == "column_exists":
        found = int(check.column in rows.columns)
        return F.lit(found).cast("bigint"), F.lit(1 - found).cast("bigint")
    if check.kind == "column_count":
        seen = len(rows.columns)
        return F.lit(seen).cast("bigint"), F.lit(int(seen != check.low)).cast("bigint")
    if check.kind == "row_count":
        return everything, F.when(_within(everything, check), 0).otherwise(1).cast("bigint")
    if check.column not in rows.columns:
        return zero, F.lit(1).cast("bigint")  # cannot be evaluated, so it fails
    if check.kind == "not_null":
        return everything, F.count_if(F.col(check.column).isNull())
    present = F.count(F.col(check.column))
    if check.kind in ("unique", "references"):
        return present, zero  # counted separately
    return present, F.count_if(~_holds(check))


def _repeated(rows: DataFrame, columns: Mapping[int, str]) -> DataFrame:
    """Per check position, the number of rows whose value occurs more than once."""
    entries = F.array(*[
        F.struct(F.lit(position).alias("position"), F.col(name).cast("string").alias("value"))
        for position, name in columns.items()
    ])
    values = rows.select(F.explode(entries).alias("entry")).select("entry.*").where(F.col("value").isNotNull())
    counted = values.groupBy("position", "value").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > 1).groupBy("position").agg(F.sum("n").alias("unexpected"))


def _aggregates(rows: DataFrame, checks: Sequence[Check]) -> list[Column]:
    found = []
    for position, check in enumerate(checks):
        elements, unexpected = _measures(rows, check)
        found += [elements.alias(f"elements_{position}"), unexpected.alias(f"unexpected_{position}")]
    return found


def _report(measured: DataFrame, counts: DataFrame | None, suite: str, checks: Sequence[Check]) -> DataFrame:
    """Result table from one row of measures and, per check position, what was counted separately."""
    table = measured.select(F.explode(F.array(*[
        F.struct(
            F.lit(suite).alias("suite"),
            F.lit(position).alias("position"),
            F.lit(check.kind).alias("check"),
            F.lit(check.column).alias("column"),
            F.col(f"elements_{position}").alias("element_count"),
            F.col(f"unexpected_{position}").alias("direct"),
            F.lit(float(check.mostly)).alias("mostly"),
        )
        for position, check in enumerate(checks)
    ])).alias("result")).select("result.*")
    unexpected = F.col("direct")
    if counts is not None:
        # at most one row per check: the hint is bounded by the length of the suite
        table = table.join(F.broadcast(counts), "position", "left")
        unexpected = F.col("direct") + F.coalesce(F.col("unexpected"), F.lit(0))
    table = table.withColumn("unexpected_count", unexpected)

    whole_table = F.col("check").isin("column_exists", "column_count", "row_count")
    judged = F.when(whole_table, F.lit(1)).otherwise(F.col("element_count"))
    passed = (judged - F.col("unexpected_count")) / judged >= F.col("mostly")
    return (
        table
        .withColumn("unexpected_ratio", F.when(judged > 0, F.col("unexpected_count") / judged)
                    .otherwise(F.col("unexpected_count").cast("double")))
        .withColumn("success", F.when(judged > 0, passed).otherwise(F.col("unexpected_count") == 0))
        .select(*RESULT_COLUMNS)
    )


def evaluate(rows: DataFrame, suite: str, checks: Sequence[Check],
             parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Result table of a suite, one row per check in the order of declaration.

    NULLs leave the denominator of every check but ``not_null``. A check over no elements passes.
    """
    measured = rows.agg(*_aggregates(rows, checks))
    separate = []
    uniques = {i: c.column for i, c in enumerate(checks) if c.kind == "unique" and c.column in rows.columns}
    if uniques:
        separate.append(_repeated(rows, uniques))
    for position, check in enumerate(checks):
        if check.kind == "references" and check.column in rows.columns:
            parent, parent_column = check.values
            share = known_key_share(rows, check.column, (parents or {})[parent], parent_column)
            separate.append(share.select(
                F.lit(position).alias("position"),
                (F.col("element_count") - F.col("known_count")).alias("unexpected"),
            ))
    counts = None
    for part in separate:
        counts = part if counts is None else counts.unionByName(part)
    return _report(measured, counts, suite, checks)


def evaluate_written(rows: DataFrame, suite: str, checks: Sequence[Check], path: str,
                     grouped_by: str | None = None) -> DataFrame:
    """Writes ``rows`` to the folder ``path`` and returns the result table of the suite, equal to ``evaluate``.

    Row-level checks are metrics of the write itself. They are collected by the last step before the files are
    written, whose tasks count once however often they are repeated. Uniqueness of ``grouped_by`` is counted on
    the way as well: the caller states that rows of one value already lie together in one task, so that counting
    them needs no further shuffle. Other unique columns, and references, are not metrics of a write:
    unique columns are counted from what was written, reading no other column; references are refused.
    """
    if any(check.kind == "references" for check in checks):
        raise ValueError(f"{suite}: references need their parents; use evaluate")
    spark, kept = rows.sparkSession, rows.columns
    uniques = {i: c.column for i, c in enumerate(checks) if c.kind == "unique" and c.column in kept}
    on_the_way = [i for i, name in uniques.items() if name == grouped_by]
    aggregates = _aggregates(rows, checks)
    if on_the_way:
        number = "_number" + "_" * max(map(len, kept))  # a name no column of rows has
        rows = rows.withColumn(number, F.count(F.lit(1)).over(Window.partitionBy(grouped_by)))
        repeats = F.count_if(F.col(grouped_by).isNotNull() & (F.col(number) > 1))
        for i in on_the_way:
            aggregates[2 * i + 1] = repeats.alias(f"unexpected_{i}")
    observation = Observation()
    rows.observe(observation, *aggregates).select(*kept).write.mode("overwrite").parquet(path)
    names = [f"{part}_{i}" for i in range(len(checks)) for part in ("elements", "unexpected")]
    metrics = observation.get
    measured = spark.createDataFrame([[metrics[name] for name in names]], ", ".join(f"{name} bigint" for name in names))
    later = {i: name for i, name in uniques.items() if i not in on_the_way}
    counts = _repeated(spark.read.parquet(path), later) if later else None
    return _report(measured, counts, suite, checks)


class QualityError(RuntimeError):
    """A gate did not open; carries the failed checks."""

    def __init__(self, suite: str, failures: Sequence):
        self.failures = failures
        lines = [f"{r['check']}({r['column']}): {r['unexpected_count']} of {r['element_count']}" for r in failures]
        super().__init__(f"{suite}: {len(failures)} checks failed\n" + "\n".join(lines))


def failures_of(results: DataFrame) -> list:
    """Failed checks as rows on the driver; their number is bounded by the suite."""
    return results.where(~F.col("success")).orderBy("position").collect()


def require(results: DataFrame, suite: str) -> None:
    """Gate: raise unless every check passed."""
    failures = failures_of(results)
    if failures:
        raise QualityError(suite, failures)


def verdict(results: DataFrame) -> DataFrame:
    """One row per suite: number of checks, number of failures, overall success."""
    return results.groupBy("suite").agg(
        F.count("*").alias("checks"),
        F.count_if(~F.col("success")).alias("failed"),
        F.every(F.col("success")).alias("success"),
    )


def freshness(rows: DataFrame, name: str, loaded_at: str, warn_hours: int, error_hours: int,
              as_of: datetime) -> DataFrame:
    """Age of the newest row against the limits; a table without rows is an error."""
    newest = rows.agg(F.max(loaded_at).alias("newest_row"))
    age = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds(F.col("newest_row"))
    status = (
        F.when(F.col("newest_row").isNull() | (F.col("age_seconds") > error_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return (
        newest.select(F.lit(name).alias("source_name"), "newest_row", age.alias("age_seconds"))
        .withColumn("status", status)
    )
