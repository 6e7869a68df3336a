import pytest
from pyspark.sql import Window, functions as F

from conftest import SMALL
from tradewind.operators import quality, suites
from tradewind.plans.tested_models import GROUPED_BY_KEY, LAYERS, READ_AGAIN, publish_tested, run_tests
from tradewind.plans.warehouse import Warehouse
from tradewind.sources.star_tables import warehouse

CHECKS = [quality.not_null("v"), quality.unique("k"), quality.in_set("v", [1, 2, 3]), quality.row_count(1, 9),
          quality.unique("v"), quality.column_exists("none"), quality.not_null("none")]
ROWS = [("a", 1), ("a", 2), ("a", 7), ("b", None), (None, 3), (None, 3)]


@pytest.mark.parametrize("grouped", [None, "k"])
@pytest.mark.parametrize("condition", ["true", "v > 100", "false"])
def test_metrics_of_a_write_equal_a_pass_of_their_own(spark, tmp_path, grouped, condition):
    rows = spark.createDataFrame(ROWS, "k string, v int").where(condition)
    written = quality.evaluate_written(rows, "t", CHECKS, f"{tmp_path}/t", grouped).orderBy("position").collect()
    assert written == quality.evaluate(rows, "t", CHECKS).orderBy("position").collect()
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/t").collect())) == sorted(map(str, rows.collect()))


def test_names_of_rows_do_not_clash_with_the_count(spark, tmp_path):
    rows = spark.createDataFrame([("a", 5), ("a", 6)], "k string, _number int")
    result = quality.evaluate_written(rows, "t", [quality.unique("k")], f"{tmp_path}/t", "k").first()
    assert result["unexpected_count"] == 2
    assert spark.read.parquet(f"{tmp_path}/t").columns == ["k", "_number"]


def test_references_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        quality.evaluate_written(spark.range(3), "t", [quality.references("id", "p", "id")], f"{tmp_path}/t")


def shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_counting_grouped_keys_shuffles_nothing(spark):
    house = warehouse(spark, SMALL)
    for name in GROUPED_BY_KEY:
        model, key = house.model(name), suites.MODEL_TESTS[name][1]
        assert shuffles(model.withColumn("_n", F.count("*").over(Window.partitionBy(key)))) == shuffles(model), name


def test_failing_model_stops_what_depends_on_it(spark, tmp_path):
    house = warehouse(spark, SMALL)
    spoiled = {"suppliers": house.raw["suppliers"],
               "customers": house.raw["customers"].withColumn("email", F.lit(None).cast("string"))}
    checks_of = lambda name: [quality.not_null("email")]
    with pytest.raises(quality.QualityError):
        publish_tested(spark, Warehouse(spoiled, house.rules), str(tmp_path), ("stg_customers", "stg_suppliers"),
                       checks_of, stop_at_failure=True)
    assert [row["suite"] for row in spark.read.parquet(f"{tmp_path}/test_results").select("suite").distinct().collect()] \
        == ["stg_customers"]


def test_models_are_read_back_and_later_ones_read_them(spark, tmp_path):
    house, results = publish_tested(spark, warehouse(spark, SMALL), str(tmp_path), ("stg_suppliers", "stg_products"))
    assert results.where(~F.col("success")).count() == 0
    assert set(house.published) == {"stg_suppliers", "stg_products"} <= set(LAYERS)
    assert house.model("stg_products").count() == warehouse(spark, SMALL).stg_products.count()


def test_tests_alone_equal_those_of_a_publication_and_write_only_what_is_read_again(spark, tmp_path):
    """All kinds of test at once; a customer without email and a repeated event are found on both ways."""
    house = warehouse(spark, SMALL)
    raw = {name: house.raw[name] for name in ("customers", "products", "suppliers", "orders_history", "order_items",
                                              "orders_stream", "clickstream", "inventory_updates")}
    raw["customers"] = raw["customers"].withColumn("email", F.expr("if(customer_id = '7', null, email)"))
    raw["orders_stream"] = raw["orders_stream"].unionByName(raw["orders_stream"].where("order_id = '3'"))
    spoiled = Warehouse(raw, house.rules)
    _, results = publish_tested(spark, spoiled, f"{tmp_path}/a")
    alone = run_tests(spark, spoiled, f"{tmp_path}/b")
    rows = [sorted(map(str, frame.collect())) for frame in (results, alone)]
    assert rows[0] == rows[1] and alone.where(~F.col("success")).count() >= 2
    written = {path.name for layer in (tmp_path / "b").iterdir() if layer.name != "test_results" for path in layer.iterdir()}
    assert written == set(READ_AGAIN)
    assert set(spark.read.parquet(f"{tmp_path}/b/marts/mart_orders").columns) == set(READ_AGAIN["mart_orders"])
