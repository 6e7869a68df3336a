import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.operators import keyed_table
from tradewind.operators.dedup import keep_latest
from tradewind.operators.keyed_table import KeyedTable
from tradewind.operators.upsert import insert_if_absent, update_from
from tradewind.sources.files import list_files

T1 = datetime(2024, 1, 1)
SCHEMA = "id string, value int, note string, _ingested_at timestamp"


def rows(spark, *given):
    return spark.createDataFrame([(k, v, n, T1 + timedelta(days=d)) for k, v, n, d in given], SCHEMA)


def content(frame):
    return sorted(map(str, frame.select("id", "value", "note", "_ingested_at").collect()))


def files_of(spark, root):
    return {row["path"] for row in list_files(spark, f"{root}/rows").collect()}


def test_merged_loads_equal_a_full_deduplication(spark, tmp_path):
    """Loads arrive out of order, with repeated keys, ties, NULL values and NULL keys; one key has a third of the rows."""
    pick, table, every = random.Random(7), KeyedTable(spark, f"{tmp_path}/t", "id", 4), None
    for n, day in enumerate((3, 1, 2, 3)):
        load = rows(spark, *[
            (pick.choice(["hot", None, *[f"k{i}" for i in range(20)]]) if pick.random() < 0.7 else "hot",
             pick.choice([None, 1, 2]), pick.choice([None, "a", "b"]), day) for _ in range(60)])
        table.merge_latest(load, f"load{n}")
        every = load if every is None else every.unionByName(load)
        assert content(table.rows()) == content(keep_latest(every.where("id IS NOT NULL"), "id"))


def test_only_changed_buckets_are_written(spark, tmp_path):
    root = f"{tmp_path}/t"
    table = KeyedTable(spark, root, "id", 8)
    table.merge_latest(rows(spark, *[(f"k{i}", 1, "", 1) for i in range(200)]), "a")
    before = files_of(spark, root)
    assert table.merge_latest(rows(spark, ("k3", 2, "", 2)), "b").count() == 1
    after = files_of(spark, root)
    assert len(before - after) == 1 and len(after - before) >= 1
    # an older row, the same load again and an empty one change nothing
    for load in (rows(spark, ("k3", 9, "", 0)), rows(spark, ("k3", 2, "", 2)), rows(spark)):
        assert table.merge_latest(load, "c").count() == 0
        assert files_of(spark, root) == after


def test_batch_that_died_is_repeated(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/t"
    table = KeyedTable(spark, root, "id", 4)
    first, second = rows(spark, ("a", 1, "", 1), ("b", 1, "", 1)), rows(spark, ("a", 2, "", 2), ("c", 2, "", 2))
    table.merge_latest(first, "one")

    def die(self, given):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(keyed_table.KeyedTable, "_replace", die)
        table.merge_latest(second, "two")
    for _ in range(2):
        table.merge_latest(second, "two")
        assert content(table.rows()) == content(keep_latest(first.unionByName(second), "id"))


def test_known_keys_keep_their_row(spark, tmp_path):
    present, more = rows(spark, ("a", 1, "", 1)), rows(spark, ("a", 2, "", 2), ("b", 5, "x", 2), ("b", 4, "y", 2), (None, 1, "", 1))
    table = KeyedTable(spark, f"{tmp_path}/t", "id", 4)
    table.insert_absent(present, "one", ["_ingested_at", "value"])
    assert table.insert_absent(more, "two", ["_ingested_at", "value"]).count() == 1
    expected = insert_if_absent(present, more.where("id IS NOT NULL"), "id", ["_ingested_at", "value"])
    assert content(table.rows()) == content(expected)


def test_update_of_columns(spark, tmp_path):
    root, start = f"{tmp_path}/t", rows(spark, *[(f"k{i}", i, "n", 1) for i in range(50)])
    table = KeyedTable(spark, root, "id", 8)
    table.insert_absent(start, "one", ["value"])
    before = files_of(spark, root)
    changes = spark.createDataFrame([("k1", 100), ("k2", 2), ("k3", None), ("none", 7)], "id string, value bigint")
    assert {row["id"] for row in table.update(changes, "two", ["value"]).collect()} == {"k1", "k3"}
    assert content(table.rows()) == content(update_from(start, changes, "id", "value", "value"))
    assert table.rows().schema["value"].dataType == start.schema["value"].dataType
    assert len(before - files_of(spark, root)) <= 2


def test_layout_stays(spark, tmp_path):
    root = f"{tmp_path}/t"
    KeyedTable(spark, root, "id", 4).merge_latest(rows(spark, ("a", 1, "", 1)), "one")
    again = KeyedTable(spark, root, "id", 16)
    assert again.buckets == 4
    again.merge_latest(rows(spark, ("a", 2, "", 2)), "two")
    assert content(again.rows()) == content(rows(spark, ("a", 2, "", 2)))
    with pytest.raises(ValueError):
        KeyedTable(spark, root, "value")
    with pytest.raises(ValueError):
        again.merge_latest(rows(spark, ("a", 3, "", 3)).withColumn("more", F.lit(1)), "three")


def test_empty_first_load(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "id", 4)
    assert table.merge_latest(rows(spark), "one").count() == 0
    table.merge_latest(rows(spark, ("a", 1, "", 1)), "two")
    assert table.rows().count() == 1
