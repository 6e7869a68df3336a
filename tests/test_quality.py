from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators import quality, suites
from tradewind.operators.aggregates import reconcile


def judged(spark, rows, check, **parents):
    return quality.evaluate(rows, "t", [check], parents).first()


@pytest.mark.parametrize("rows, mostly, passes", [
    (100, 0.99, True), (99, 0.99, False), (1000, 0.999, True), (999, 0.999, False), (10_000, 1.0, False)])
def test_one_bad_row_against_the_tolerance(spark, rows, mostly, passes):
    table = spark.range(rows).select(F.when(F.col("id") > 0, F.col("id")).alias("v"))
    result = judged(spark, table, quality.not_null("v", mostly))
    assert result["success"] is passes
    assert (result["element_count"], result["unexpected_count"]) == (rows, 1)


def test_nulls_leave_the_denominator_of_other_checks(spark):
    table = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    for check in (quality.in_set("v", ["a"]), quality.matches("v", "^a$"), quality.unique("v")):
        assert judged(spark, table, check)["element_count"] == 2
    assert judged(spark, table, quality.in_set("v", ["a"], 0.5))["success"]


def test_every_member_of_a_repeated_value_is_unexpected(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 3), (None, 5)], "v string, n int")
    results = quality.evaluate(table, "t", [quality.unique("v"), quality.not_null("v"), quality.unique("n")]).collect()
    assert [(r["unexpected_count"], r["success"]) for r in results] == [(2, False), (2, False), (2, False)]


def test_bounds_are_inclusive_and_may_be_open(spark):
    table = spark.createDataFrame([(0,), (5,), (10,)], "v int")
    assert judged(spark, table, quality.between("v", 0, 10))["success"]
    assert judged(spark, table, quality.between("v", 1))["unexpected_count"] == 1
    assert judged(spark, table, quality.between("v", high=4))["unexpected_count"] == 2


def test_references_count_rows_not_keys(spark):
    child = spark.createDataFrame([("a",)] * 97 + [("x",)] * 3 + [(None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    result = judged(spark, child, quality.references("k", "p", "k", 0.97), p=parent)
    assert (result["element_count"], result["unexpected_count"], result["success"]) == (100, 3, True)


def test_missing_column_fails_its_checks_without_stopping_the_suite(spark):
    table = spark.range(3)
    checks = [quality.column_exists("gone"), quality.not_null("gone"), quality.unique("gone"),
              quality.column_count(1), quality.row_count(1, 5)]
    assert [r["success"] for r in quality.evaluate(table, "t", checks).orderBy("position").collect()] == [
        False, False, False, True, True]


def test_empty_table(spark):
    table = spark.createDataFrame([], "v int")
    checks = [quality.not_null("v"), quality.unique("v"), quality.between("v", 1, 2), quality.row_count(1, None)]
    assert [r["success"] for r in quality.evaluate(table, "t", checks).orderBy("position").collect()] == [
        True, True, True, False]


def test_gate_names_the_failures(spark):
    results = quality.evaluate(spark.range(2), "t", [quality.between("id", 1), quality.not_null("id")])
    with pytest.raises(quality.QualityError, match=r"between\(id\): 1 of 2") as caught:
        quality.require(results, "t")
    assert len(caught.value.failures) == 1
    quality.require(quality.evaluate(spark.range(2), "t", [quality.not_null("id")]), "t")


def test_suites_have_the_declared_sizes():
    sizes = {name: len(build()) for name, build in suites.SUITES.items()}
    assert sizes == {"customers": 25, "orders_history": 27, "orders_stream": 40, "clickstream": 35,
                     "inventory_updates": 41}
    strict = [c.mostly for c in suites.orders_stream(mostly=1.0) if c.kind in ("not_null", "matches")]
    assert set(strict) == {1.0}


def test_models_have_106_column_tests():
    kinds = [check.kind for model in suites.MODEL_TESTS for check in suites.model_checks(model)]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("in_set")) == (77, 18, 11)


def test_a_valid_customers_table_passes_its_suite(spark):
    rows = spark.range(1000).select(
        F.format_string("00000000-0000-0000-0000-%012d", "id").alias("customer_id"),
        *[F.lit("x").alias(name) for name in ("first_name", "last_name")],
        F.concat(F.lit("u"), F.col("id"), F.lit("@x.org")).alias("email"),
        *[F.lit("x").alias(name) for name in ("phone", "address", "city", "state", "country", "postal_code")],
        *[F.lit("2024-01-01").cast("timestamp").alias(name) for name in ("created_at", "updated_at")])
    assert rows.columns == schemas.CUSTOMERS.names
    assert quality.verdict(quality.evaluate(rows, "customers", suites.customers())).first()["success"]


@pytest.mark.parametrize("hour, status", [(24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hour, status):
    loaded = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp")
    as_of = datetime(2024, 1, 1 + hour // 24, hour % 24)
    assert quality.freshness(loaded, "s", "t", 24, 48, as_of).first()["status"] == status
    assert quality.freshness(loaded.limit(0), "s", "t", 24, 48, as_of).first()["status"] == "error"


def test_reconciliation(spark):
    source = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 0), ("d", 10)], "table_name string, row_count long")
    target = spark.createDataFrame([("a", 990), ("b", 989), ("c", 5)], "table_name string, row_count long")
    got = {r["table_name"]: r["within_tolerance"] for r in reconcile(source, target).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False}
