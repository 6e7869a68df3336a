"""Files of different types, checkpointed discovery and staged publishing."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tradewind.operators import quality
from tradewind.plans.topic_load import TopicLayout, load_new_files, pending_loads, set_aside
from tradewind.sources import discovery, publish, shapes, state
from tradewind.sources.files import list_files

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("seen", T.TimestampType()), T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("_loaded_at", T.TimestampType()), T.StructField("_source_file", T.StringType())])


@pytest.fixture
def where(tmp_path):
    return TopicLayout(*[f"{tmp_path}/{part}" for part in ("landed", "table", "rejects", "manifest")])


def land(spark, where, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(where.landed)


def test_files_of_different_types_load_or_are_rejected_by_row(spark, where, tmp_path):
    land(spark, where, [(1, datetime(2024, 1, 1), Decimal("1.50"))], "id bigint, seen timestamp, price decimal(10,2)")
    land(spark, where, [("2", "2024-01-02T00:00:00+00:00", "2.5"), ("x", "never", "3")], "id string, seen string, price string")
    land(spark, where, [(3, date(2024, 1, 3), 3.25), (4, None, 4.125)], "ID int, seen date, price double")
    land(spark, where, [(5.0, True), (5.5, None)], "id double, seen boolean")
    land(spark, where, [([6], 1)], "id array<int>, extra int")
    (tmp_path / "landed" / "broken.parquet").write_bytes(b"not a parquet file")
    assert load_new_files(spark, "t", where, SCHEMA) == 1
    table = spark.read.parquet(where.table)
    assert table.schema["id"].dataType == T.LongType()
    assert sorted((r["id"], r["seen"], r["price"]) for r in table.collect()) == [
        (1, datetime(2024, 1, 1), Decimal("1.50")), (2, datetime(2024, 1, 2), Decimal("2.50")),
        (3, datetime(2024, 1, 3), Decimal("3.25"))]
    rejects = spark.read.option("mergeSchema", "true").parquet(where.rejects).collect()
    assert sorted((r["id"] or "", r["_rejected"]) for r in rejects) == [
        ("", ""), ("4", "price"), ("5.0", "seen"), ("5.5", "id"), ("[6]", "id"), ("x", "id,seen")]
    broken, = [r for r in rejects if r["_problem"]]
    assert broken["_source_file"].endswith("broken.parquet")
    assert state.manifest(spark, where.manifest).count() == 6
    assert load_new_files(spark, "t", where, SCHEMA) == 0


def test_lattice():
    long, int_, text, double = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
    wide, narrow = T.DecimalType(20, 4), T.DecimalType(10, 2)
    cases = {(int_, long): "widens", (long, int_): "narrows", (long, long): "same", (text, long): "parses", (long, text): "widens",
             (T.FloatType(), double): "widens", (double, long): "narrows", (narrow, wide): "widens", (wide, narrow): "narrows",
             (T.BooleanType(), long): "unfit", (T.DateType(), T.TimestampType()): "widens", (T.TimestampType(), T.DateType()): "narrows",
             (long, T.TimestampType()): "unfit", (text, T.ArrayType(long)): "unfit", (T.NullType(), long): "same"}
    assert {pair: shapes.convertible(*pair) for pair in cases} == cases


def test_narrowing_loses_no_value_silently(spark):
    rows = spark.createDataFrame([(1, 1.0, datetime(2024, 1, 1)), (1 << 40, 1.5, datetime(2024, 1, 1, 5)), (None, None, None)],
                                 "a bigint, b double, c timestamp")
    wanted = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.LongType()), T.StructField("c", T.DateType())])
    good, bad = shapes.fitted(rows, wanted)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 1, date(2024, 1, 1)), (None, None, None)]
    assert [r["_rejected"] for r in bad.collect()] == ["a,b,c"]


def test_footers_beyond_pyarrow_are_read_by_spark(spark, where, monkeypatch):
    land(spark, where, [(1,)], "id int")
    land(spark, where, [("1",)], "id string")
    paths = [r["path"] for r in list_files(spark, where.landed).collect()]
    here = sorted(map(tuple, shapes.physical_schemas(spark, paths).select("path", "shape").collect()))
    monkeypatch.setattr(shapes, "IN_PLACE", ())
    assert sorted(map(tuple, shapes.physical_schemas(spark, paths).select("path", "shape").collect())) == here
    assert len({shape for _, shape in here}) == 2


def test_parts_are_bounded_and_repeated_when_they_fail(spark, where):
    for i in range(5):
        land(spark, where, [(i,)], "id bigint")
    seen = []

    def take(found, number):
        seen.append((number, sorted(r["path"] for r in found.collect())))
        if len(seen) == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        discovery.each_part(spark, where.landed, where.progress, 2, take)
    discovery.each_part(spark, where.landed, where.progress, 2, take)
    assert [number for number, _ in seen] == [0, 1, 1, 2] and seen[1] == seen[2]
    assert [len(paths) for _, paths in seen] == [2, 2, 2, 1]
    assert len({path for _, paths in seen for path in paths}) == 5


def test_refused_loads_stay_staged_and_are_judged_with_what_is_new(spark, where):
    checks = [quality.unique("id"), quality.column_count(3)]
    land(spark, where, [(1, None, None)], "id bigint, seen timestamp, price decimal(10,2)")
    assert load_new_files(spark, "t", where, SCHEMA, checks[:1]) == 1
    land(spark, where, [(2, None, None), (2, None, None)], "id bigint, seen timestamp, price decimal(10,2)")
    with pytest.raises(quality.QualityError):
        load_new_files(spark, "t", where, SCHEMA, checks[:1])
    before = {r["path"]: r["modified"] for r in list_files(spark, where.table).collect()}
    land(spark, where, [(3, None, None)], "id bigint, seen timestamp, price decimal(10,2)")
    with pytest.raises(quality.QualityError):  # the refused load is still there
        load_new_files(spark, "t", where, SCHEMA, checks[:1])
    assert before == {r["path"]: r["modified"] for r in list_files(spark, where.table).collect()}
    assert pending_loads(spark, where) == [1, 2]
    results = spark.read.parquet(where.staging.results)
    assert [(r["check"], r["success"]) for r in results.collect()] == [("unique", False)]
    set_aside(spark, where, [1])
    assert load_new_files(spark, "t", where, SCHEMA, checks[:1]) == 1
    assert sorted(r["id"] for r in spark.read.parquet(where.table).collect()) == [1, 3]
    rejects = spark.read.parquet(where.rejects).collect()
    assert [(r["id"], r["_rejected"]) for r in rejects] == [("2", "gate")] * 2


def test_structure_checks_see_the_columns_of_the_files(spark, where):
    checks = [quality.column_exists("price"), quality.column_count(2)]
    land(spark, where, [(1, 1)], "id bigint, surprise int")
    with pytest.raises(quality.QualityError) as caught:
        load_new_files(spark, "t", where, SCHEMA, checks)
    assert [f["check"] for f in caught.value.failures] == ["column_exists"]


def test_publishing_keeps_other_partitions(spark, tmp_path):
    where = publish.Staging(f"{tmp_path}/staged", f"{tmp_path}/table", f"{tmp_path}/results")
    for day, n in (("2024-01-01", 3), ("2024-01-02", 2)):
        publish.stage(spark.range(n), where, "day", day)
        publish.publish(spark, "t", where, "day", [day], [quality.row_count(1, 10)])
    files = {r["path"] for r in list_files(spark, where.table).collect() if "day=2024-01-01" in r["path"]}
    publish.stage(spark.range(1), where, "day", "2024-01-02")
    publish.publish(spark, "t", where, "day", ["2024-01-02"])
    assert {r["path"] for r in list_files(spark, where.table).collect() if "day=2024-01-01" in r["path"]} == files
    counts = {f"{r['day']}": r["count"] for r in spark.read.parquet(where.table).groupBy("day").count().collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 1}
    publish.stage(spark.range(0), where, "day", "2024-01-02")
    publish.publish(spark, "t", where, "day", ["2024-01-02"])
    assert spark.read.parquet(where.table).where("day = '2024-01-02'").count() == 0
