import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from samples import raw
from tradewind import schemas
from tradewind.operators import quality, upsert
from tradewind.operators.ranking import sample_n, top_n
from tradewind.plans.batch_load import (
    Layout, RowCountMismatch, extract_increment, load_dated, reconcile_load, require_reconciled,
)
from tradewind.plans.topic_load import TopicLayout, load_new_files
from tradewind.sources import files, registry, sinks, state
from tradewind.sources.extract import as_landed, as_text, since

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def layout(tmp_path):
    return Layout(f"{tmp_path}/landing", f"{tmp_path}/table", f"{tmp_path}/state")


def numbered(spark, low, high):
    start = F.lit("2024-01-01").cast("timestamp")
    return spark.range(low, high).select("id", (start + F.make_dt_interval(F.col("id").cast("int"))).alias("created_at"))


def test_increment_takes_only_what_is_new(spark, tmp_path):
    where = layout(tmp_path)
    assert extract_increment(spark, numbered(spark, 0, 5), "t", "created_at", where, datetime(2024, 2, 1))
    assert not extract_increment(spark, numbered(spark, 0, 5), "t", "created_at", where, datetime(2024, 2, 2))
    assert extract_increment(spark, numbered(spark, 0, 8), "t", "created_at", where, datetime(2024, 2, 3))
    mark = state.watermarks(spark, where.state).first()
    assert (mark["last_row_count"], mark["last_extracted_at"]) == (3, datetime(2024, 1, 8))
    assert files.read_files(spark, where.landing).count() == 8


def test_full_extract_has_no_mark(spark, tmp_path):
    where = layout(tmp_path)
    for run in (1, 2):
        assert extract_increment(spark, numbered(spark, 0, 5), "items", None, where, datetime(2024, 2, run))
    assert state.watermarks(spark, where.state).first()["last_extracted_at"] is None


def test_marks_of_other_tables_stay(spark, tmp_path):
    where = layout(tmp_path)
    for name, size in (("a", 3), ("b", 4), ("a", 6)):
        rows = numbered(spark, 0, size)
        state.advance(spark, where.state, state.watermark_of(rows, name, "created_at", datetime(2024, 2, 1), "p"))
    assert {r["table_name"]: r["last_row_count"] for r in state.watermarks(spark, where.state).collect()} == {
        "a": 6, "b": 4}


def test_inclusive_mark_reads_the_last_instant_again(spark):
    rows = numbered(spark, 0, 5)
    assert since(rows, "created_at", datetime(2024, 1, 4)).count() == 1
    assert since(rows, "created_at", datetime(2024, 1, 4), inclusive=True).count() == 2


def test_repeated_date_replaces_itself(spark, tmp_path):
    where = layout(tmp_path)
    stamp = datetime(2024, 1, 1, 2)
    load_dated(spark, spark.range(5), "t", where, D1, loaded_at=stamp)
    load_dated(spark, spark.range(7), "t", where, D2, loaded_at=stamp)
    again = load_dated(spark, spark.range(3), "t", where, D1, loaded_at=stamp)
    assert again.count() == 3 and spark.read.parquet(where.table).count() == 10
    report = reconcile_load({"t": spark.range(3)}, {"t": again}).first()
    assert report["within_tolerance"]


def test_repeating_a_date_without_rows_empties_it(spark, tmp_path):
    where = layout(tmp_path)
    load_dated(spark, spark.range(5), "t", where, D1)
    load_dated(spark, spark.range(2), "t", where, D2)
    assert load_dated(spark, spark.range(0), "t", where, D1).count() == 0
    assert spark.read.parquet(where.table).count() == 2


def test_failed_gate_leaves_the_table_alone(spark, tmp_path):
    where = layout(tmp_path)
    load_dated(spark, spark.range(1, 5), "t", where, D1)
    with pytest.raises(quality.QualityError):
        load_dated(spark, spark.range(0, 9), "t", where, D1, [quality.between("id", 1)])
    assert spark.read.parquet(where.table).count() == 4


def test_run_time_layout_skips_empty_extracts(spark, tmp_path):
    base = f"{tmp_path}/runs"
    assert sinks.write_run(spark.range(2), base, datetime(2024, 3, 4, 5))
    assert not sinks.write_run(spark.range(0), base, datetime(2024, 3, 5, 5))
    written = spark.read.parquet(base)
    assert [(r["year"], r["month"], r["day"]) for r in written.distinct().select("year", "month", "day").distinct().collect()] == [(2024, 3, 4)]
    assert sinks.holds(written, 2) and not sinks.holds(written, 3)


def test_landed_text_keeps_null(spark):
    rows = spark.createDataFrame([(None, datetime(2024, 1, 2, 3, 4, 5), 7)], "a string, t timestamp, n int")
    assert as_text(rows).first().asDict() == {"a": None, "t": "2024-01-02T03:04:05+00:00", "n": "7"}
    assert as_landed(rows).schema["n"].dataType == T.IntegerType()


def test_align_is_by_name_and_strict(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    got = sinks.align(spark.createDataFrame([("1", "x")], "A string, extra string"), schema)
    assert got.first().asDict() == {"a": 1, "b": None}
    with pytest.raises(PySparkException):
        sinks.align(spark.createDataFrame([("one",)], "a string"), schema).collect()


def test_rejected_rows_keep_their_values_and_reasons(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.TimestampType())])
    rows = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-01"), ("y", "z"), (None, None)], "n string, t string")
    good, bad = sinks.split_loadable(rows, schema)
    assert good.count() == 2 and good.schema["n"].dataType == T.IntegerType()
    assert {(r["n"], r["_rejected"]) for r in bad.collect()} == {("x", "n"), ("y", "n,t")}


def test_declared_sources(spark, tmp_path):
    table = raw(spark, "suppliers", dict(supplier_id="s1"))
    sinks.write_parquet(table, f"{tmp_path}/suppliers")
    assert registry.read_source(spark, str(tmp_path), "suppliers").collect() == table.collect()
    sizes = {name: len(source.schema) for name, source in registry.SOURCES.items()}
    assert sizes["customers"] == 13 and sizes["clickstream"] == 20


def test_files_are_found_and_missing_ones_are_an_error(spark, tmp_path):
    spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/x/part")
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/x/_delta_log")
    spark.range(1).coalesce(1).write.json(f"{tmp_path}/x/json")
    found = files.list_files(spark, f"{tmp_path}/x")
    assert found.count() == 1
    assert files.read_files(spark, f"{tmp_path}/x").count() == 1
    (tmp_path / "empty").mkdir()
    for call in (lambda: files.read_files(spark, []), lambda: files.read_newest(spark, f"{tmp_path}/empty"),
                 lambda: files.read_files(spark, f"{tmp_path}/empty", schemas.CUSTOMERS)):
        with pytest.raises(FileNotFoundError):
            call()


def test_newest_file_breaks_ties_by_path(spark):
    same = datetime(2024, 1, 1)
    listing = spark.createDataFrame(
        [("a", same), ("c", same), ("b", same), ("z", same - timedelta(days=1))], "path string, modified timestamp")
    assert files.newest_file(listing) == "c"
    assert files.newest_file(listing.limit(0)) is None


def test_newest_extract_is_read_whole(spark, tmp_path):
    for day, low in ((1, 0), (2, 100)):
        spark.range(low, low + 100, numPartitions=4).write.parquet(f"{tmp_path}/x/run_date=2024-01-0{day}")
    got = files.read_newest(spark, f"{tmp_path}/x")
    assert sorted(r["id"] for r in got.collect()) == list(range(100, 200))


def test_newest_file_in_the_root_is_an_extract(spark, tmp_path):
    for low in (0, 5):
        spark.range(low, low + 5, numPartitions=1).write.mode("append").parquet(f"{tmp_path}/flat")
        time.sleep(1.1)  # a later modification time
    assert sorted(r["id"] for r in files.read_newest(spark, f"{tmp_path}/flat").collect()) == [5, 6, 7, 8, 9]


def topic_layout(tmp_path):
    return TopicLayout(*[f"{tmp_path}/{part}" for part in ("landed", "table", "rejects", "manifest")])


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("_loaded_at", T.TimestampType()),
                       T.StructField("_source_file", T.StringType())])


def land(spark, where, *values):
    rows = spark.createDataFrame([(value,) for value in values], "id string")
    rows.coalesce(1).write.mode("append").parquet(where.landed)


def test_every_file_is_loaded_once(spark, tmp_path):
    where = topic_layout(tmp_path)
    for value in "123":
        land(spark, where, value)
    assert load_new_files(spark, "t", where, SCHEMA, files_per_load=2) == 2  # slices of two
    assert load_new_files(spark, "t", where, SCHEMA, files_per_load=2) == 0
    land(spark, where, "4", "oops", "5")
    assert load_new_files(spark, "t", where, SCHEMA) == 1
    table = spark.read.parquet(where.table)
    assert sorted(r["id"] for r in table.collect()) == [1, 2, 3, 4, 5]
    assert [r["id"] for r in spark.read.parquet(where.rejects).collect()] == ["oops"]
    assert table.where(F.col("_source_file").isNull() | F.col("_loaded_at").isNull()).isEmpty()


def test_load_that_died_before_the_manifest_is_repeated(spark, tmp_path, monkeypatch):
    where = topic_layout(tmp_path)
    land(spark, where, "1", "2")

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(state, "mark_loaded", die)
        load_new_files(spark, "t", where, SCHEMA)
    land(spark, where, "3")
    load_new_files(spark, "t", where, SCHEMA)
    assert sorted(r["id"] for r in spark.read.parquet(where.table).collect()) == [1, 2, 3]


def test_gate_blocks_new_files(spark, tmp_path):
    where = topic_layout(tmp_path)
    land(spark, where, "1", None)
    with pytest.raises(quality.QualityError):
        load_new_files(spark, "t", where, SCHEMA, [quality.not_null("id")])
    assert state.manifest(spark, where.manifest).isEmpty()


@pytest.mark.parametrize("size", [1, 10])
def test_verdict_does_not_depend_on_slices(spark, tmp_path, size):
    where = topic_layout(tmp_path)
    for values in (("1", "2"), ("2", "3")):
        land(spark, where, *values)
    with pytest.raises(quality.QualityError):
        load_new_files(spark, "t", where, SCHEMA, [quality.unique("id")], files_per_load=size)
    assert state.manifest(spark, where.manifest).isEmpty()


def test_insert_if_absent_keeps_what_is_there(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    candidates = spark.createDataFrame([("a", 9), ("b", 7), ("b", 3), ("c", None)], "k string, v int")
    got = upsert.insert_if_absent(target, candidates, "k", ["v"])
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 3), ("c", None)]


def test_update_keeps_rows_without_change_and_takes_null(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    changes = spark.createDataFrame([("a", 5), ("b", None), ("x", 9)], "k string, new int")
    got = upsert.update_from(target, changes, "k", "v", "new")
    assert sorted(map(tuple, got.collect())) == [("a", 5), ("b", None), ("c", 3)]


def test_compaction_keeps_rows_and_writes_few_files(spark, tmp_path):
    source, target = f"{tmp_path}/many", f"{tmp_path}/few"
    spark.range(400).repartition(16).withColumn("hour", F.col("id") % 3).write.partitionBy("hour").parquet(source)
    sinks.compact(spark, source, target, ["hour"])
    assert spark.read.parquet(target).count() == 400
    assert files.list_files(spark, target).count() < files.list_files(spark, source).count()


def test_created_table_stamps_insertions(spark, tmp_path):
    for _ in range(2):
        sinks.ensure_table(spark, "stamped", schemas.SUPPLIERS, f"{tmp_path}/stamped")
    sinks.insert_rows(spark, spark.createDataFrame([("s1",)], "supplier_id string"), "stamped")
    row = spark.table("stamped").first()
    assert row["supplier_id"] == "s1" and row["_ingested_at"] is not None and row["email"] is None
    spark.sql("DROP TABLE stamped")


def test_sample_does_not_depend_on_partitioning(spark):
    rows = spark.range(1000)
    one, other = (sorted(r["id"] for r in sample_n(rows.repartition(n), "id", 10, seed=3).collect()) for n in (1, 7))
    assert one == other and len(set(one)) == 10
    assert one != sorted(r["id"] for r in sample_n(rows, "id", 10, seed=4).collect())
    assert [r["id"] for r in top_n(rows, 3, F.desc("id")).collect()] == [999, 998, 997]


def test_a_row_count_mismatch_stops_the_run(spark):
    require_reconciled(reconcile_load({"a": spark.range(100)}, {"a": spark.range(99)}))
    with pytest.raises(RowCountMismatch, match="b: 5 of 100 rows"):
        require_reconciled(reconcile_load(
            {"a": spark.range(100), "b": spark.range(100)}, {"a": spark.range(100), "b": spark.range(5)}))


def test_drift_of_the_source_does_not_reach_the_table(spark, tmp_path):
    layout = Layout(f"{tmp_path}/landing", f"{tmp_path}/table", "")
    wanted = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    drifted = spark.createDataFrame([("x", "a", 1)], "extra string, NAME string, id int")
    loaded = load_dated(spark, drifted, "t", layout, date(2024, 1, 1), schema=wanted)
    assert {"id", "name", "_ingested_at", "load_date"} == set(loaded.columns)
    assert loaded.select("id", "name").collect() == [(1, "a")]
