import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators import quality
from tradewind.plans import staging
from tradewind.streaming import gate, ingest, versions

NOW = {"availableNow": True}
START = datetime(2024, 1, 1, 22, 30)


def message(number, **fields):
    body = fields.pop("body", None) or json.dumps({
        "event_id": f"e{number}", "event_type": "order_created", "event_timestamp": "2024-01-01T00:00:00+00:00",
        "total_amount": 10.5, "item_count": 2, **fields})
    return (f"k{number}".encode(), body.encode(), 0, number, START + timedelta(minutes=20 * number))


def store(spark, folder, *messages):
    spark.createDataFrame(list(messages), ingest.BROKER_ROW).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def topic(spark, tmp_path):
    folder = f"{tmp_path}/topic"
    store(spark, folder, message(0), message(1, shipping_city="Rome"))
    store(spark, folder, message(2, total_amount=None), message(3, body="{broken"), message(4, extra=1))
    return folder


def test_parsing(spark, topic):
    parsed = ingest.parse_topic(spark.read.schema(ingest.BROKER_ROW).parquet(topic), schemas.ORDERS_STREAM)
    assert parsed.columns == [*schemas.landed("orders_stream").names, *schemas.HOUR_PARTITIONS]
    rows = {row["kafka_key"]: row for row in parsed.collect()}
    assert rows["k1"]["shipping_city"] == "Rome" and rows["k2"]["total_amount"] is None
    assert rows["k3"]["event_id"] is None and rows["k4"]["event_id"] == "e4"
    assert (rows["k4"]["day"], rows["k4"]["hour"], rows["k0"]["hour"]) == (1, 23, 22)


def test_stream_lands_what_batch_parses_and_resumes(spark, topic, tmp_path):
    target, progress = f"{tmp_path}/landed", f"{tmp_path}/progress"

    def run():
        rows = ingest.read_topic_files(spark, topic, files_per_trigger=1)
        ingest.land(ingest.parse_topic(rows, schemas.ORDERS_STREAM), target, progress, trigger=NOW).awaitTermination()

    run()
    run()  # nothing new: nothing doubled
    store(spark, topic, message(5))
    run()
    batch = ingest.parse_topic(spark.read.schema(ingest.BROKER_ROW).parquet(topic), schemas.ORDERS_STREAM)
    key = lambda frame: sorted(map(str, frame.drop("ingested_at").collect()))
    assert key(ingest.landed_table(spark, "orders_stream", target)) == key(
        batch.select(*schemas.landed("orders_stream").names))
    assert spark.read.parquet(target).where("hour = 22").count() == 2


def test_staging_runs_on_a_stream(spark, topic, tmp_path):
    def staged(rows):
        traced = ingest.parse_topic(rows, schemas.ORDERS_STREAM).withColumns({
            "_loaded_at": F.lit(START).cast("timestamp"), "_source_file": F.lit("f")})
        return staging.stg_orders_stream(traced).drop("ingested_at")

    target = f"{tmp_path}/staged"
    writer = staged(ingest.read_topic_files(spark, topic)).writeStream.format("parquet").option("path", target)
    writer.option("checkpointLocation", f"{tmp_path}/p").trigger(**NOW).start().awaitTermination()
    batch = staged(spark.read.schema(ingest.BROKER_ROW).parquet(topic))
    assert sorted(map(str, spark.read.parquet(target).collect())) == sorted(map(str, batch.collect()))
    assert batch.count() == 4  # the broken payload has no event id


CHECKS = [quality.not_null("event_id"), quality.between("item_count", 1)]


def test_bad_batches_go_to_quarantine(spark, topic, tmp_path):
    good, bad = f"{tmp_path}/good", f"{tmp_path}/bad"
    rows = ingest.parse_topic(ingest.read_topic_files(spark, topic, files_per_trigger=1), schemas.ORDERS_STREAM)
    write = gate.gated_batch("orders_stream", CHECKS, good, bad)
    gate.land_gated(rows, f"{tmp_path}/progress", write, NOW).awaitTermination()
    # each stored file holds one slice; the one with the broken payload is kept apart as a whole
    sizes = sorted((spark.read.parquet(good).count(), spark.read.parquet(bad).count()))
    assert sizes == [2, 3] and spark.read.parquet(bad).where("event_id is null").count() == 1


def test_repeated_batch_replaces_itself(spark, tmp_path):
    good = f"{tmp_path}/good"
    write = gate.gated_batch("t", [], good, f"{tmp_path}/bad")
    write(spark.range(5), 0)
    write(spark.range(7), 1)
    write(spark.range(5), 0)
    assert spark.read.parquet(good).count() == 12
    assert versions.read_version(spark, good, 0).count() == 5
    counted = {r["version"]: (r["version_rows"], r["current_rows"], r["rows_added"])
               for r in versions.version_counts(spark, good, [0, 1]).collect()}
    assert counted == {0: (5, 12, 7), 1: (12, 12, 0)}


def test_all_versions_are_counted_in_one_scan(spark, tmp_path):
    good = f"{tmp_path}/good"
    write = gate.gated_batch("t", [], good, f"{tmp_path}/bad")
    for batch, rows in enumerate((3, 0, 4)):
        write(spark.range(rows), batch)
    counted = versions.version_counts(spark, good, [2, 0, 1, 0])
    assert sorted(map(tuple, counted.select("version", "version_rows", "rows_added").collect())) == [
        (0, 3, 4), (1, 3, 4), (2, 7, 0)]
    plan = counted._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<>" in plan


def test_repeated_batch_moves_when_judged_differently(spark, tmp_path):
    good, bad = f"{tmp_path}/good", f"{tmp_path}/bad"
    rows = spark.createDataFrame([(None,), ("a",)], "event_id string")
    gate.gated_batch("t", [], good, bad)(rows, 0)
    gate.gated_batch("t", CHECKS, good, bad)(rows, 0)
    assert (spark.read.parquet(good).count(), spark.read.parquet(bad).count()) == (0, 2)


def test_audit(spark):
    report = versions.audit(spark.range(4), "t").first()
    assert (report["row_count"], report["column_count"], report["schema_text"]) == (4, 1, "struct<id:bigint>")
