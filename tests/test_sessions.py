from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tradewind.plans.intermediate import int_clickstream_sessionized
from tradewind.streaming.sessions import closing_sessions, land_sessions

START = datetime(2024, 1, 1, 12)
SCHEMA = ("event_id string, session_id string, event_type string, event_timestamp timestamp, user_id string, "
          "is_anonymous boolean, page_url string, product_id string, category string, device_type string, browser string, "
          "referrer string, time_on_page_sec decimal(10,2)")


def clicks(spark, *given):
    """(session, minute, user, page) of each click."""
    kinds = ("PAGE_VIEW", "PRODUCT_VIEW", "ADD_TO_CART", "PURCHASE")
    return spark.createDataFrame([
        (f"e{n}-{minute}", session, kinds[minute % 4], START + timedelta(minutes=minute), user, user is None, page,
         f"p{minute % 3}", "c", "mobile", "safari", "ref", None) for n, (session, minute, user, page) in enumerate(given)], SCHEMA)


def rows(frame):
    return sorted(map(str, frame.collect()))


def streamed(spark, tmp_path, *batches):
    """What has been emitted after each batch, each a run of its own over one checkpoint."""
    source, target = f"{tmp_path}/clicks", f"{tmp_path}/sessions"
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        land_sessions(closing_sessions(stream), target, f"{tmp_path}/progress", {"availableNow": True}).awaitTermination()
        yield spark.read.parquet(target)


FIRST = (("s", 0, "u2", "/a"), ("s", 5, "u1", "/b"), ("t", 3, None, "/a"), (None, 2, None, "/a"))
SECOND = (("s", 20, "u1", "/a"), ("s", 28, "u1", None), ("t", 4, "u9", "/c"))
FAR = (("later", 500, None, "/x"),)


def test_sessions_are_sent_once_when_closed_and_equal_the_batch(spark, tmp_path):
    parts = [clicks(spark, *part) for part in (FIRST, SECOND, FAR)]
    found = [(emitted.count(), rows(emitted)) for emitted in streamed(spark, tmp_path, *parts)]
    assert [n for n, _ in found] == [0, 0, 3]  # open until the watermark passes; the last click is open still
    whole = int_clickstream_sessionized(parts[0].unionByName(parts[1]))
    assert found[2][1] == rows(whole.select(*spark.read.parquet(f"{tmp_path}/sessions").columns))


def test_late_clicks_are_dropped_and_later_ones_open_a_session(spark, tmp_path):
    late = clicks(spark, ("s", 1, "u1", "/late"), ("s", 510, "u1", "/again"))
    *_, last = streamed(spark, tmp_path, clicks(spark, *FIRST), clicks(spark, *FAR), late, clicks(spark, ("end", 900, None, "/")))
    ends = {(row["session_id"], row["total_events"], row["session_start"]) for row in last.where("session_id = 's'").collect()}
    assert ends == {("s", 2, START), ("s", 1, START + timedelta(minutes=510))}
    assert last.where("session_id = 'later'").count() == 1


def test_clicks_out_of_order_join_two_spans(spark):
    far = clicks(spark, ("s", 0, "u", "/a"), ("s", 50, "u", "/b"))
    assert closing_sessions(far).count() == 2
    joined = closing_sessions(far.unionByName(clicks(spark, ("s", 25, "u", "/c"))))
    assert joined.select("total_events", "unique_pages_viewed").collect() == [(3, 3)]


def test_odd_clicks(spark):
    assert closing_sessions(clicks(spark, *FIRST).limit(0)).count() == 0
    untimed = clicks(spark, ("s", 0, None, None)).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    assert closing_sessions(untimed).count() == 0
    row = closing_sessions(clicks(spark, (None, 0, None, None))).first()
    assert (row["session_id"], row["user_id"], row["unique_pages_viewed"], row["total_events"]) == (None, None, 0, 1)
