import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.sources import jdbc
from tradewind.sources.ranges import plan_ranges


def sizes(rows, conditions):
    """Rows in each range; every row must be in exactly one."""
    counts = rows.select(*[F.coalesce(F.expr(condition), F.lit(False)).cast("int").alias(f"r{n}")
                           for n, condition in enumerate(conditions)])
    names = counts.columns
    assert counts.where(sum((F.col(name) for name in names), F.lit(0)) != 1).count() == 0
    return list(counts.agg(*[F.coalesce(F.sum(name), F.lit(0)) for name in names]).first())


def test_even_ranges_of_a_skewed_column(spark):
    rows = spark.range(4000).select((F.col("id") ** 4).cast("decimal(30,0)").alias("v"))
    found = sizes(rows, plan_ranges(rows, "v", 8))
    assert len(found) == 8 and min(found) > 0 and max(found) < 600


def test_hot_value_is_cut_by_another_column(spark):
    pick = random.Random(1)
    rows = spark.createDataFrame(
        [(7 if pick.random() < 0.5 else pick.randrange(100), n) for n in range(4000)], "v int, n bigint").repartition(4)
    alone, cut = sizes(rows, plan_ranges(rows, "v", 8)), sizes(rows, plan_ranges(rows, "v", 8, tie="n"))
    assert min(alone) > 0 and max(alone) > 1900
    assert min(cut) > 0 and max(cut) < 1000


@pytest.mark.parametrize("values", [
    [None] * 10 + [1, 2], [5] * 20, [1] * 10 + [2] * 10, [None], [], [3, None], list(range(3)), [1] * 30 + [2, 3, 4]])
def test_no_range_is_empty_and_nulls_are_read(spark, values):
    rows = spark.createDataFrame([(v, n) for n, v in enumerate(values)], "v int, n int")
    for tie in (None, "n"):
        found = sizes(rows, plan_ranges(rows, "v", 4, tie))
        assert sum(found) == len(values)
        assert not values or min(found) > 0


def test_dates_and_times(spark):
    rows = spark.createDataFrame([(date(2020, 1, 1) + timedelta(days=n), datetime(2020, 1, 1) + timedelta(seconds=n * n))
                                  for n in range(300)], "d date, t timestamp")
    for column in ("d", "t"):
        found = sizes(rows, plan_ranges(rows, column, 5))
        assert len(found) == 5 and min(found) > 40


def test_values_the_copy_did_not_have_are_covered(spark):
    copy = spark.range(100, 200).withColumnRenamed("id", "v")
    rows = spark.range(0, 400).withColumnRenamed("id", "v").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    assert sum(sizes(rows, plan_ranges(copy, "v", 4))) == 401


def test_text_and_odd_names_are_refused(spark):
    with pytest.raises(ValueError):
        plan_ranges(spark.createDataFrame([("a",)], "v string"), "v", 4)
    with pytest.raises(ValueError):
        plan_ranges(spark.createDataFrame([(1,)], "`v or 1` int"), "v or 1", 4)


class Recorder:
    """Notes how a reader is set up; there is no database here."""

    def __init__(self):
        self.read, self.set, self.predicates = self, [], None

    def format(self, kind):
        return self

    def options(self, **given):
        self.set.append(given)
        return self

    def load(self):
        return self

    def first(self):
        return {"low": 1, "high": 9}

    def jdbc(self, url, table, predicates, properties):
        self.predicates = predicates


def test_reader_is_split_by_default():
    asked = Recorder()
    jdbc.read_table(asked, "jdbc:x", "shop.customers", {})
    question, reading = asked.set
    assert question["query"] == "SELECT min(created_at) AS low, max(created_at) AS high FROM shop.customers"
    assert (reading["partitionColumn"], reading["lowerBound"], reading["upperBound"], reading["numPartitions"]) == (
        "created_at", "1", "9", "16")
    planned = Recorder()
    jdbc.read_table(planned, "jdbc:x", "customers", {}, ranges=["a < 1", "a >= 1"])
    assert planned.predicates == ["a < 1", "a >= 1"] and not planned.set
    whole = Recorder()
    jdbc.read_table(whole, "jdbc:x", "order_items", {})
    assert "partitionColumn" not in whole.set[0]
