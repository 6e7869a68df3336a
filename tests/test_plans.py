"""The physical plans: what must be pruned, pushed down and combined, and how hot keys are handled."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tradewind.operators import aggregates, suites
from tradewind.operators.dedup import keep_latest
from tradewind.operators.joins import known_key_share, lookup, orphans
from tradewind.plans import intermediate, marts
from tradewind.plans.warehouse import Warehouse
from tradewind.registry import catalogue
from tradewind.sources import registry, sinks
from tradewind.sources.extract import since
from tradewind.sources.star_tables import RAW, warehouse


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("model", suites.MODEL_TESTS)
def test_models_have_no_cross_join_row_multiplication_or_python(spark, no_broadcast, model):
    plan = plan_of(warehouse(spark, SMALL).model(model))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "Expand", "Python",
                      "SinglePartition"):
        assert forbidden not in plan, forbidden


@pytest.mark.parametrize("model", ["stg_customers", "stg_orders_history", "stg_order_items"])
def test_latest_row_is_limited_before_the_shuffle(spark, model):
    plan = plan_of(warehouse(spark, SMALL).model(model))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange hashpartitioning.*WindowGroupLimit.*Partial", plan, re.S)


def test_sources_prune_columns_and_push_filters(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_parquet(sinks.align(RAW["customers"](spark, SMALL), registry.SOURCES["customers"].schema),
                        f"{root}/customers")
    customers = registry.read_source(spark, root, "customers")
    from datetime import datetime

    plan = plan_of(since(customers, "created_at", datetime(1994, 3, 1)).select("customer_id"))
    assert "ReadSchema: struct<customer_id:string,created_at:timestamp>" in plan
    assert "PushedFilters: [IsNotNull(created_at), GreaterThan(created_at,1994-03-01" in plan


def test_typed_times_are_pushed_down(spark, tmp_path):
    from tradewind.plans.staging import stg_orders_history

    sinks.write_parquet(sinks.align(RAW["orders_history"](spark, SMALL), registry.SOURCES["orders_history"].schema,
                                    strict=False), f"{tmp_path}/orders_history")
    plan = plan_of(stg_orders_history(registry.read_source(spark, str(tmp_path), "orders_history")))
    assert "PushedFilters: [IsNotNull(order_id), IsNotNull(order_date), IsNotNull(created_at)]" in plan


def test_latest_row_prunes_when_loads_cannot_repeat_a_key(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    plan = plan_of(keep_latest(events, "event_id", "ts", ties=()).select("event_id", "value"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_dated_partitions_are_pruned(spark, tmp_path):
    from datetime import date

    from tradewind.sources.files import read_partition

    for day in (1, 2, 3):
        sinks.write_dated(spark.range(day), f"{tmp_path}/t", date(2024, 1, day))
    one = read_partition(spark, f"{tmp_path}/t", "2024-01-02")
    assert one.count() == 2 and len(one.inputFiles()) > 0
    assert "PartitionFilters: [isnotnull(run_date" in plan_of(one)


def test_order_summary_reuses_the_partitioning_of_the_join(spark, no_broadcast):
    house = warehouse(spark, SMALL)
    lines = intermediate.sold_lines(house.stg_order_items, house.stg_orders_history).withColumn("category", F.lit("x"))
    summary, plain = plan_of(marts.order_line_summary(lines)), plan_of(lines)
    assert summary.count("Exchange hashpartitioning") == plain.count("Exchange hashpartitioning")


def test_orders_are_deduplicated_once_for_both_branches(spark, no_broadcast):
    frame = warehouse(spark, SMALL).mart_orders
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    assert "ReusedExchange" in execution.executedPlan().toString()


# ------------------------------------------------------------------ hot keys
def hot(spark, rows=30_000):
    """A third of the rows carries one key, a third no key at all, the rest spreads."""
    number = F.col("id")
    key = F.when(number % 3 == 0, "hot").when(number % 3 == 1, F.concat(F.lit("k"), number % 1000))
    return spark.range(rows).select(number, key.alias("key"), (number % 7).cast("string").alias("value"))


@pytest.fixture
def eager_skew(spark, no_broadcast):
    """Skew thresholds small enough for test data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def heated(spark):
    """Raw tables in which one order, product, customer and user hold a third of the rows."""
    house = warehouse(spark, SMALL)

    def heat(name, key, by, value):
        rows = house.raw[name].repartition(8)
        return rows.withColumn(key, F.when(F.crc32(by) % 3 == 0, value).otherwise(F.col(key)))

    items = heat("order_items", "order_id", "order_item_id", "7")
    items = items.withColumn("product_id", F.when(F.crc32("order_item_id") % 3 == 1, "11").otherwise(F.col("product_id")))
    raw = {name: house.raw[name] for name in ("customers", "suppliers", "products")} | {
        "order_items": items,
        "orders_history": heat("orders_history", "customer_id", "order_id", "5"),
        "orders_stream": heat("orders_stream", "customer_id", "event_id", "3"),
        "inventory_updates": heat("inventory_updates", "product_id", "event_id", "11"),
        "clickstream": heat("clickstream", "user_id", "session_id", "3"),
    }
    return Warehouse(raw, house.rules)


@pytest.mark.parametrize("model, joins", [
    ("int_order_lines", ["order_id", "product_id"]), ("int_inventory_enriched", ["_probe"]),
    ("mart_orders", ["order_id"]), ("mart_products", ["order_id"])])
def test_hot_keys_are_split_and_change_no_result(spark, eager_skew, model, joins):
    """Also where an aggregation on the same key follows."""
    frame = heated(spark).model(model)
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    final = execution.executedPlan().toString().split("Initial Plan")[0]
    split = re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", final)
    assert set(joins) <= set(split), split
    with_split = sorted(map(str, frame.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert with_split == sorted(map(str, heated(spark).model(model).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_without_a_key_are_scattered(spark, no_broadcast):
    facts = hot(spark)
    dimension = spark.createDataFrame([("hot", 1), ("k1", 2), (None, 3)], "key string, extra int")
    got = lookup(facts, dimension, "key", "key", {"extra": "extra"}, spread_by=("id",), matched="found")
    brute = facts.join(dimension.where("key is not null"), "key", "left")
    assert got.count() == 30_000
    for condition in ("extra = 1", "extra = 2", "extra is null"):
        assert got.where(condition).count() == brute.where(condition).count()
    assert got.where("key is null and found").isEmpty()
    exchanged = got.select("key", F.spark_partition_id().alias("part")).where("key is null").groupBy("part").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in exchanged.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_a_key_that_looks_scattered_does_not_match(spark):
    facts = spark.createDataFrame([(None, 1)], "key string, id int")
    probe = facts.select(F.concat(F.lit("absent-"), F.xxhash64("id").cast("string")).alias("key")).first()["key"]
    dimension = spark.createDataFrame([(probe, 1)], "key string, extra int")
    got = lookup(facts, dimension, "key", "key", {"extra": "extra"}, spread_by=("id",), matched="found").first()
    assert got["extra"] is None and got["found"] is False


def test_key_checks_join_each_key_once(spark, no_broadcast):
    facts, parent = hot(spark), spark.createDataFrame([("hot",), ("k1",)], "key string")
    known = facts.where("key = 'hot' or key = 'k1'").count()
    share = known_key_share(facts, "key", parent, "key").first()
    assert (share["element_count"], share["known_count"]) == (20_000, known)
    missing = orphans(facts, "key", parent, "key")
    assert missing.agg(F.sum("child_rows")).first()[0] == 20_000 - known
    plan = plan_of(missing)
    assert re.search(r"SortMergeJoin.*HashAggregate.*Exchange.*HashAggregate", plan, re.S)


def test_most_frequent_of_a_hot_group_with_many_values(spark):
    rows = hot(spark).withColumn("many", F.when(F.col("id") % 2 == 0, F.lit("often")).otherwise(F.col("id").cast("string")))
    got = {r["key"]: r["top"] for r in aggregates.most_frequent(rows, ["key"], "many", "top").collect()}
    assert got["hot"] == "often" and got[None] == "often"


def test_hot_session_equals_brute_force(spark):
    """One session holds a third of the clicks; every count is checked against plain aggregates."""
    clicks = warehouse(spark, SMALL).stg_clickstream
    number = F.substring("event_id", 4, 12).cast("int")
    skewed = clicks.withColumn("session_id", F.when(number % 3 == 0, "hot").otherwise(F.col("session_id")))
    got = intermediate.int_clickstream_sessionized(skewed).where("session_id = 'hot'").first()
    plain = skewed.where("session_id = 'hot'").agg(
        F.count("*").alias("n"), F.countDistinct("page_url").alias("pages"),
        F.countDistinct("product_id").alias("products"), F.countDistinct("category").alias("categories"),
        F.mode("user_id", True).alias("user"), F.sum("time_on_page_sec").alias("time")).first()
    assert (got["total_events"], got["unique_pages_viewed"], got["unique_products_viewed"],
            got["unique_categories_viewed"], got["user_id"], got["total_time_on_site_sec"]) == tuple(plain)


def test_hot_product_and_day_equal_brute_force(spark):
    house = warehouse(spark, SMALL)
    lines = house.int_order_lines
    skewed = lines.withColumn("product_id", F.when(F.crc32("order_item_id") % 3 == 0, "hot").otherwise(F.col("product_id")))
    got = marts.product_sales(skewed).where("_sold = 'hot'").first()
    plain = skewed.where("product_id = 'hot' and not is_cancelled and not is_refunded").agg(
        F.countDistinct("order_id"), F.sum("quantity"), F.sum("line_revenue"), F.countDistinct("customer_id")).first()
    assert (got["total_orders"], got["total_units_sold"], got["total_revenue"], got["unique_customers"]) == tuple(plain)

    orders = house.mart_orders
    day = F.when(F.crc32("order_id") % 3 == 0, F.lit("2000-01-01").cast("date")).otherwise(F.col("order_date_day"))
    busy = orders.withColumn("order_date_day", day)
    got = marts.mart_revenue_daily(busy).where("date_day = '2000-01-01'").first()
    plain = busy.where("order_date_day = '2000-01-01' and not is_cancelled and not is_refunded").agg(
        F.countDistinct("order_id"), F.countDistinct("customer_id"), F.sum("total_amount"),
        F.mode("customer_country", True)).first()
    assert (got["total_orders"], got["unique_customers"], got["gross_revenue"],
            got["top_customer_country"]) == tuple(plain)


def test_daily_revenue_reads_no_products(spark):
    plan = plan_of(warehouse(spark, SMALL).mart_revenue_daily)
    assert "p_partkey" not in plan and plan.count("l_orderkey") and plan.count("ReadSchema: struct<l_") == 1


def test_known_keys_are_read_without_other_columns(spark):
    plan = plan_of(catalogue.queries()["join11_known_customer_share"].plain(spark, SMALL))
    assert "c_name" not in plan and "Window" not in plan


@pytest.mark.parametrize("query", ["mdl07_customers", "agg04_count_distinct"])
def test_counts_need_no_map_and_multiply_no_rows(spark, query):
    plan = plan_of(catalogue.queries()[query].plain(spark, SMALL))
    assert "Expand" not in plan and "ObjectHashAggregate" not in plan
