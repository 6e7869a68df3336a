"""What several runs, models or batches need is computed once, and what no one needs any more is not kept."""

import time

from pyspark.sql import functions as F, types as T

from conftest import SMALL
from tradewind.plans.warehouse import Warehouse
from tradewind.operators import quality
from tradewind.registry import expressions, loading, topics
from tradewind.session import CLEANUP
from tradewind.sources import publish, sinks
from tradewind.sources.star_tables import warehouse


def sources(rows):
    return " ".join(rows.inputFiles())


def test_marts_of_all_dates_read_one_order_summary(spark):
    """Orders and their lines were deduplicated and joined again for each date."""
    tables = loading.history_tables(spark, SMALL)
    for number in range(len(loading.STATES)):
        found = sources(loading.mart_at(tables, number))
        assert "history-customer_orders" in found and "lineitem" not in found and "orders.parquet" not in found


def test_customer_mart_reads_customers_once(spark):
    """A customer's orders were joined to the customers before they were counted for them."""
    plan = warehouse(spark, SMALL).mart_customers._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [c_custkey") == 1


def test_revenue_reads_published_lines(spark, tmp_path):
    house = warehouse(spark, SMALL)
    house.int_order_lines.write.parquet(f"{tmp_path}/int_order_lines")
    lines = spark.read.parquet(f"{tmp_path}/int_order_lines")
    revenue = Warehouse(house.raw, house.rules, {"int_order_lines": lines}, house.ties).mart_revenue_daily
    assert "lineitem" not in sources(revenue)
    assert not revenue.exceptAll(house.mart_revenue_daily).count() and revenue.count() == house.mart_revenue_daily.count()


def test_a_stream_joins_customers_that_are_staged_already(spark, monkeypatch):
    """Each batch of the stream staged all customers again."""
    joined = []
    made = topics.intermediate.int_streaming_orders_enriched
    monkeypatch.setattr(topics.intermediate, "int_streaming_orders_enriched",
                        lambda events, customers, floors: joined.append(customers) or made(events, customers, floors))
    topics.REGISTER.entries["str08_stream_static_enrichment"][0](spark, SMALL)
    assert "customer.parquet" not in sources(joined[0])


def test_a_replaced_partition_is_computed_once(spark, tmp_path):
    """A first pass only found out whether there were rows."""
    seen = spark.sparkContext.accumulator(0)

    def note(value):
        seen.add(1)
        return value

    noted = F.udf(note, T.LongType()).asNondeterministic()
    sinks.replace_partition(spark.range(8, numPartitions=1).select(noted("id").alias("id")), f"{tmp_path}/t", "day", "a")
    assert seen.value == 8
    assert spark.read.parquet(f"{tmp_path}/t").count() == 8
    sinks.replace_partition(spark.range(0).select("id"), f"{tmp_path}/t", "day", "a")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 0


def test_shuffles_start_with_many_partitions(spark):
    """What one task sorts and holds grew with the tables, at the number of partitions the session had."""
    warehouse(spark, SMALL).stg_customers
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1000


def shuffled(spark):
    """Names of the shuffle files on the disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in files.mkString(" ").split() if "/shuffle_" in x}


def left_behind(spark, before):
    for _ in range(50):  # files go a moment after the write
        left = shuffled(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def test_a_staged_load_leaves_no_shuffle_files(spark, tmp_path):
    """The files of all loads stayed until the driver happened to collect its garbage."""
    where = publish.Staging(f"{tmp_path}/staged", f"{tmp_path}/table", f"{tmp_path}/results")
    rows, before = spark.range(500).repartition(3, "id"), shuffled(spark)
    publish.stage(rows, where, "day", "2024-01-01")
    assert not left_behind(spark, before)
    publish.publish(spark, "t", where, "day", ["2024-01-01"], [quality.unique("id")])
    assert not left_behind(spark, before)
    assert spark.read.parquet(where.table).count() == 500 and spark.conf.get(CLEANUP, "false") == "false"


def test_layers_leave_no_shuffle_files_and_are_packed(spark):
    before = shuffled(spark)
    result = expressions.REGISTER.entries["mac04_layer_schema"][0](spark, SMALL)
    assert not left_behind(spark, before)
    assert all(".zstd." in x for x in result.inputFiles()) and result.count() == 4
