from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.functions import classify, keys, money, temporal, text


def one(spark, column, **values):
    kinds = ", ".join(f"{name} {kind}" for name, (kind, _) in values.items()) or "_ int"
    row = tuple(value for _, value in values.values()) or (0,)
    return spark.createDataFrame([row], kinds).select(column.alias("result")).first()["result"]


@pytest.mark.parametrize("first, last, expected", [
    (" Ada ", "Byron", "Ada Byron"), (None, "Byron", " Byron"), ("Ada", None, "Ada "), (None, None, " ")])
def test_full_name_keeps_the_blank(spark, first, last, expected):
    assert one(spark, text.full_name("f", "l"), f=("string", first), l=("string", last)) == expected


@pytest.mark.parametrize("user, expected", [
    (None, True), ("Guest ", True), ("null", True), ("", True), ("  ", True), ("u1", False)])
def test_anonymous_users(spark, user, expected):
    assert one(spark, text.is_anonymous("u"), u=("string", user)) is expected


@pytest.mark.parametrize("address, city, country", [
    (None, "Unknown", "US"), ("1 Main St", "Unknown", "US"), ("1 Main St, Springfield", "Springfield", "US"),
    ("1 Main St, Paris , France", "Paris", "France"), ("a, b, c, d", "b", "d"),
    ("a," + "x" * 60 + "," + "y" * 60, "x" * 50, "y" * 50)])
def test_address_parts(spark, address, city, country):
    assert one(spark, text.city_of("a"), a=("string", address)) == city
    assert one(spark, text.country_of("a"), a=("string", address)) == country


def test_template_sku_and_offset(spark):
    assert one(spark, text.fill_template(F.lit("/p/{id}?x"), F.col("v")), v=("string", None)) == "/p/unknown?x"
    assert one(spark, text.sku_prefix(F.col("c"), F.lit(42)), c=("string", "Home & Garden")) == "H&G-00042"
    assert one(spark, text.sku_prefix(F.col("c"), F.lit(1234567)), c=("string", "Toys")) == "T-1234567"
    assert one(spark, text.colon_offset(F.lit("2024-01-01T00:00:00+0530"))) == "2024-01-01T00:00:00+05:30"


@pytest.mark.parametrize("value, expected", [
    ("2024-05-01T10:00:00.5+02:00", datetime(2024, 5, 1, 8, 0, 0, 500000)), ("2024-05-01", datetime(2024, 5, 1)),
    ("yesterday", None), ("", None), (None, None), ("2024-13-01", None)])
def test_unreadable_times_become_null(spark, value, expected):
    assert one(spark, temporal.parse_time("t").cast("timestamp_ntz"), t=("string", value)) == expected


def test_differences_count_boundaries(spark):
    def time(value):
        return F.lit(value).cast("timestamp")

    assert one(spark, temporal.days_between(time("2024-01-01 23:00"), time("2024-01-02 01:00"))) == 1
    assert one(spark, temporal.seconds_between(time("2024-01-01 00:00:00.9"), time("2024-01-01 00:00:01.1"))) == 1
    assert one(spark, temporal.days_between(time("2024-01-02"), time("2024-01-01"))) == -1


def test_calendar_of_a_sunday(spark):
    spine = temporal.date_spine(F.lit("2024-03-03 15:00").cast("timestamp"))
    assert one(spark, spine["day_of_week"]) == 1
    assert one(spark, spine["day_name"]) == "Sunday"
    assert one(spark, spine["date_week"].cast("string")) == "2024-02-26 00:00:00"  # the Monday before


@pytest.mark.parametrize("price, discount, expected", [
    ("10.00", "0.1500", "8.50"), ("10.00", None, "10.00"), ("0.05", "0.1000", "0.05"), ("2.50", "0.2500", "1.88")])
def test_net_price_rounds_half_away(spark, price, discount, expected):
    result = one(spark, money.net_unit_price("p", "d"), p=("decimal(12,2)", Decimal(price)),
                 d=("decimal(12,4)", discount and Decimal(discount)))
    assert result == Decimal(expected)


def test_averages_and_shares(spark):
    average = money.average(F.lit(Decimal("10.00")), F.lit(3))
    assert one(spark, average) == Decimal("3.333333")
    assert one(spark, money.average(F.lit(Decimal("0")), F.lit(0))) is None
    assert one(spark, money.share(F.lit(2), F.lit(3))) == Decimal("0.6667")
    assert one(spark, money.cents_to_dollars(F.lit(1005), 1)) == Decimal("10.1")


@pytest.mark.parametrize("amount, tier", [
    ("99.99", "low"), ("100", "medium"), ("499.99", "medium"), ("500", "high"), (None, "low")])
def test_order_tiers(spark, amount, tier):
    value = amount and Decimal(amount)
    assert one(spark, classify.order_value_tier(F.col("a")), a=("decimal(12,2)", value)) == tier


@pytest.mark.parametrize("value, orders, segment", [
    ("499.99", 1, "bronze"), ("500", 1, "silver"), ("1000", 1, "gold"), ("2000", 1, "platinum"), ("0", 0, "prospect")])
def test_segments(spark, value, orders, segment):
    got = classify.customer_segment(F.col("v"), F.col("n"))
    assert one(spark, got, v=("decimal(12,2)", Decimal(value)), n=("int", orders)) == segment


@pytest.mark.parametrize("quantity, health", [
    (0, "out_of_stock"), (1, "critical"), (10, "critical"), (11, "low"), (50, "low"), (51, "healthy"),
    (None, "healthy"), (-1, "critical")])
def test_stock_health(spark, quantity, health):
    assert one(spark, classify.stock_health(F.col("q")), q=("int", quantity)) == health


@pytest.mark.parametrize("change, kind, large", [
    (5, "restock", False), (-101, "depletion", True), (0, "adjustment", False), (None, "adjustment", False)])
def test_movements(spark, change, kind, large):
    assert one(spark, classify.movement_type(F.col("c")), c=("int", change)) == kind
    assert one(spark, classify.is_large_movement(F.col("c")), c=("int", change)) is large


@pytest.mark.parametrize("revenue, tier", [
    ("10000", "top_performer"), ("9999.99", "strong"), ("1000", "moderate"), ("0.01", "low_performer"),
    ("0", "no_sales")])
def test_performance(spark, revenue, tier):
    assert one(spark, classify.performance_tier(F.col("r")), r=("decimal(12,2)", Decimal(revenue))) == tier


def test_keys(spark):
    with_null = one(spark, keys.surrogate_key("a", "b"), a=("string", None), b=("int", 1))
    with_text = one(spark, keys.surrogate_key("a", "b"), a=("string", ""), b=("int", 1))
    assert with_null != with_text and len(with_null) == 32
    assert keys.schema_name(None, "RAW") == "RAW" and keys.schema_name(" MARTS ", "RAW") == "MARTS"
