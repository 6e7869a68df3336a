import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.operators import history_table
from tradewind.operators.history import apply_history, start_history
from tradewind.operators.history_table import read_history, run_history
from tradewind.sources.files import list_files

T1 = datetime(2024, 1, 1)
CHECK = ["segment", "value"]
SCHEMA = "id string, segment string, value int, note string"


def state(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def versions(df):
    return sorted(map(str, df.select("id", "segment", "value", "note", "scd_id", "updated_at", "valid_from", "valid_to").collect()))


def files_of(spark, root, table):
    return {r["path"]: r["modified"] for r in list_files(spark, f"{root}/{table}").collect()}


@pytest.mark.parametrize("close_missing", [True, False])
def test_partitioned_history_equals_the_plain_one(spark, tmp_path, close_missing):
    pick, root, plain = random.Random(4), f"{tmp_path}/h", None
    for n in range(5):
        as_of = T1 + timedelta(days=n)
        rows = [(f"k{i}", pick.choice("abc"), pick.choice([1, None]), f"run {n}") for i in range(30) if pick.random() < 0.8]
        current = state(spark, rows)
        run_history(spark, root, current, "id", CHECK, as_of, close_missing, buckets=4)
        plain = start_history(current, "id", as_of) if plain is None else apply_history(
            plain, current, "id", CHECK, as_of, close_missing)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        assert versions(read_history(spark, root)) == versions(plain)


def test_only_touched_files_are_written(spark, tmp_path):
    root = f"{tmp_path}/h"
    rows = [(f"k{i}", "a", 1, "") for i in range(200)]
    run_history(spark, root, state(spark, rows), "id", CHECK, T1, buckets=8)
    rows[3] = ("k3", "b", 1, "")
    run_history(spark, root, state(spark, rows), "id", CHECK, T1 + timedelta(days=1), buckets=8)
    closed, kept = files_of(spark, root, "closed"), files_of(spark, root, "open")
    rows[3] = ("k3", "c", 1, "")
    changes = run_history(spark, root, state(spark, rows), "id", CHECK, T1 + timedelta(days=2), buckets=8)
    assert changes.count() == 1
    # closed versions of the run before keep their files, and so do seven of eight buckets
    assert closed.items() <= files_of(spark, root, "closed").items()
    after = files_of(spark, root, "open")
    changed = {path.split("_bucket=")[1].split("/")[0] for path in kept.items() ^ after.items() for path in [path[0]]}
    assert len(changed) == 1
    # a run without changes writes nothing at all
    run_history(spark, root, state(spark, rows), "id", CHECK, T1 + timedelta(days=3), buckets=8)
    assert after == files_of(spark, root, "open")


def test_run_that_died_before_opening_is_repeated(spark, tmp_path, monkeypatch):
    root, later = f"{tmp_path}/h", T1 + timedelta(days=1)
    first = [("a", "x", 1, ""), ("b", "x", 1, ""), ("c", "x", 1, "")]
    second = [("a", "y", 1, ""), ("c", "x", 1, ""), ("d", "x", 1, "")]
    run_history(spark, root, state(spark, first), "id", CHECK, T1, buckets=2)
    replace = history_table._replace

    def die(rows, path, column):
        if path.endswith("/open"):
            raise OSError("lost")
        replace(rows, path, column)

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(history_table, "_replace", die)
        run_history(spark, root, state(spark, second), "id", CHECK, later, buckets=2)
    run_history(spark, root, state(spark, second), "id", CHECK, later, buckets=2)
    once = versions(read_history(spark, root))
    run_history(spark, root, state(spark, second), "id", CHECK, later, buckets=2)
    assert once == versions(read_history(spark, root))
    plain = apply_history(start_history(state(spark, first), "id", T1), state(spark, second), "id", CHECK, later)
    assert once == versions(plain)


def test_empty_states_and_null_keys(spark, tmp_path):
    root = f"{tmp_path}/h"
    run_history(spark, root, state(spark, [("a", "x", 1, ""), (None, "x", 1, "")]), "id", CHECK, T1, buckets=2)
    run_history(spark, root, state(spark, []), "id", CHECK, T1 + timedelta(days=1), buckets=2)
    assert [r["valid_to"] for r in read_history(spark, root).collect()] == [T1 + timedelta(days=1)]
    run_history(spark, root, state(spark, [("a", "x", 1, "")]), "id", CHECK, T1 + timedelta(days=2), buckets=2)
    assert read_history(spark, root).where(F.col("valid_to").isNull()).count() == 1
    assert read_history(spark, root).count() == 2
