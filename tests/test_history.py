from datetime import datetime

from tradewind.operators.history import apply_history, history_changes, start_history

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
CHECK = ["segment", "value"]


def state(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, segment string, value int, note string")


def spans(history):
    return sorted((r["id"], r["segment"], r["valid_from"], r["valid_to"]) for r in history.collect())


FIRST = [("a", "gold", 1, "x"), ("b", "gold", 1, "x"), ("c", "gold", None, "x"), ("d", "gold", 1, "x")]
SECOND = [("a", "silver", 1, "x"), ("b", "gold", 1, "changed"), ("c", "gold", None, "x"), ("e", "new", 1, "x")]


def test_versions(spark):
    history = start_history(state(spark, *FIRST), "id", T1)
    after = apply_history(history, state(spark, *SECOND), "id", CHECK, T2)
    none = None
    assert sorted(((r["id"], r["segment"], r["valid_from"], r["valid_to"]) for r in after.collect()), key=str) == sorted([
        ("a", "gold", T1, T2), ("a", "silver", T2, none),  # changed
        ("b", "gold", T1, none),                           # only an unchecked column changed
        ("c", "gold", T1, none),                           # NULL equals NULL
        ("d", "gold", T1, T2),                             # gone
        ("e", "new", T2, none),                            # new
    ], key=str)
    assert {r["note"] for r in after.collect() if r["id"] == "b"} == {"x"}


def test_null_to_value_is_a_change(spark):
    history = start_history(state(spark, ("c", "gold", None, "")), "id", T1)
    after = apply_history(history, state(spark, ("c", "gold", 5, "")), "id", CHECK, T2)
    assert after.count() == 2


def test_rerun_changes_nothing(spark):
    history = start_history(state(spark, *FIRST), "id", T1)
    once = apply_history(history, state(spark, *SECOND), "id", CHECK, T2)
    twice = apply_history(once, state(spark, *SECOND), "id", CHECK, T3)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_missing_keys_may_stay_open(spark):
    history = start_history(state(spark, *FIRST), "id", T1)
    after = apply_history(history, state(spark, *SECOND), "id", CHECK, T2, close_missing=False)
    assert [r["valid_to"] for r in after.collect() if r["id"] == "d"] == [None]


def test_a_key_that_returns_opens_a_new_version(spark):
    history = start_history(state(spark, ("d", "gold", 1, "")), "id", T1)
    closed = apply_history(history, state(spark), "id", CHECK, T2)
    back = apply_history(closed, state(spark, ("d", "gold", 1, "")), "id", CHECK, T3)
    assert sorted((r["valid_from"], r["valid_to"]) for r in back.collect() if r["valid_to"]) == [(T1, T2)]
    assert [(r["valid_from"]) for r in back.collect() if r["valid_to"] is None] == [T3]
    assert len({r["scd_id"] for r in back.collect()}) == 2


def test_changes_leave_settled_versions_out(spark):
    history = start_history(state(spark, ("a", "gold", 1, "")), "id", T1)
    second = apply_history(history, state(spark, ("a", "silver", 1, "")), "id", CHECK, T2)
    changes = history_changes(second, state(spark, ("a", "bronze", 1, "")), "id", CHECK, T3)
    assert sorted(r["segment"] for r in changes.collect()) == ["bronze", "silver"]
