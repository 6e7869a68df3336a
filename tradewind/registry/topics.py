"""Event topics (STR), the streaming source and sink (SRC-6, SNK-7) and versions (SRC-7, SRC-8).

A broker is stood in for by Parquet files of broker rows, read as a stream. Every query runs to the
end of what is there and returns the table it left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind import schemas
from tradewind.operators import suites
from tradewind.plans import intermediate, staging, topic_load
from tradewind.registry.contract import MODEL_COLUMNS, rendered_sql
from tradewind.registry.register import Register
from tradewind.session import fresh_folder
from tradewind.sources.registry import SOURCES
from tradewind.sources.star_tables import RAW, RULES, warehouse
from tradewind.streaming import gate, ingest, sessions, versions

REGISTER = Register()
query = REGISTER.query
C = F.col
NOW = {"availableNow": True}
SLICES = 4


def topic_rows(events: DataFrame, topic: str) -> DataFrame:
    """Raw events as a broker would deliver them: key, JSON payload, position and time."""
    payload = F.to_json(F.struct(*schemas.TOPICS[topic].names))
    return events.select(
        F.encode("kafka_key", "UTF-8").alias("key"),
        F.encode(payload, "UTF-8").alias("value"),
        C("kafka_partition").alias("partition"),
        C("kafka_offset").cast("bigint").alias("offset"),
        C("kafka_timestamp").alias("timestamp"),
    )


def store_topic(spark, folder, topic: str) -> str:
    """Broker rows of a whole topic, written by all tasks."""
    path = fresh_folder(spark, f"topic-{topic}")
    topic_rows(RAW[topic](spark, folder), topic).write.parquet(path)
    return path


def in_slices(spark, folder, topic: str, start) -> None:
    """A topic that arrives slice by slice: broker partition n comes while the query that ``start``
    makes of the stream is down, and is taken as batch n when it is started again."""
    path = fresh_folder(spark, f"slices-{topic}")
    rows = topic_rows(RAW[topic](spark, folder), topic)
    for part in range(SLICES):
        rows.where(C("partition") == part).write.mode("append").parquet(path)
        start(ingest.read_topic_files(spark, path)).awaitTermination()


def run_topics(spark, folder, *topics: str) -> dict[str, str]:
    """Land the topics, one query each, side by side; returns the landed folders."""
    jobs = [
        ingest.TopicJob(
            topic, ingest.read_topic_files(spark, store_topic(spark, folder, topic)),
            fresh_folder(spark, f"landed-{topic}"), fresh_folder(spark, f"progress-{topic}"),
        )
        for topic in topics
    ]
    for running in ingest.land_topics(jobs, trigger=NOW):
        running.awaitTermination()
    return {job.topic: job.path for job in jobs}


@query("src06_topic_source", """
    SELECT kafka_key, kafka_partition, kafka_offset, length(event_id) > 0 AS has_payload FROM raw_clickstream""")
def _(spark, folder):
    rows = ingest.read_topic_files(spark, store_topic(spark, folder, "clickstream"))
    target, progress = fresh_folder(spark, "src06"), fresh_folder(spark, "src06-progress")
    seen = rows.select(
        C("key").cast("string").alias("kafka_key"), C("partition").alias("kafka_partition"),
        C("offset").alias("kafka_offset"), (F.length("value") > 0).alias("has_payload"))
    writer = seen.writeStream.format("parquet").option("path", target).option("checkpointLocation", progress)
    writer.trigger(**NOW).start().awaitTermination()
    return spark.read.parquet(target)


def versioned(spark, folder) -> str:
    """Order events landed in four batches, kept per batch number."""
    target, progress = fresh_folder(spark, "versions"), fresh_folder(spark, "versions-progress")
    write = gate.gated_batch("orders_stream", [], target, fresh_folder(spark, "versions-bad"))
    in_slices(spark, folder, "orders_stream", lambda rows: gate.land_gated(
        ingest.parse_topic(rows, schemas.ORDERS_STREAM), progress, write, NOW))
    return target


@query("src07_current_version", "SELECT event_id, order_id, total_amount AS amount FROM raw_orders_stream")
def _(spark, folder):
    current = versions.read_current(spark, versioned(spark, folder))
    return current.select("event_id", "order_id", C("total_amount").alias("amount"))


@query("src08_time_travel", """
    SELECT v AS version, count(*) FILTER (kafka_partition <= v) AS version_rows, count(*) AS current_rows,
           count(*) FILTER (kafka_partition > v) AS rows_added
    FROM raw_orders_stream, (VALUES (0), (1)) versions(v) GROUP BY v""")
def _(spark, folder):
    return versions.version_counts(spark, versioned(spark, folder), [0, 1])


@query("snk07_streaming_append", """
    SELECT event_id, kafka_offset, kafka_partition, year(kafka_timestamp) AS year, month(kafka_timestamp) AS month,
           day(kafka_timestamp) AS day, hour(kafka_timestamp) AS hour FROM raw_orders_stream""")
def _(spark, folder):
    landed = run_topics(spark, folder, "orders_stream")["orders_stream"]
    return spark.read.parquet(landed).select(
        "event_id", "kafka_offset", "kafka_partition", *schemas.HOUR_PARTITIONS)


@query("str01_all_topics", " UNION ALL ".join(
    f"SELECT '{topic}' AS topic, kafka_partition, count(*) AS events FROM raw_{topic} GROUP BY kafka_partition"
    for topic in schemas.TOPICS))
def _(spark, folder):
    result = None
    for topic, path in run_topics(spark, folder, *schemas.TOPICS).items():
        counted = ingest.landed_table(spark, topic, path).groupBy("kafka_partition").agg(F.count("*").alias("events"))
        part = counted.select(F.lit(topic).alias("topic"), "kafka_partition", "events")
        result = part if result is None else result.unionByName(part)
    return result


@query("str02_parse_topic", f"""
    SELECT kafka_key, kafka_offset, kafka_partition, {rendered_sql('kafka_timestamp')},
           {', '.join(schemas.CLICKSTREAM.names)} FROM raw_clickstream""")
def _(spark, folder):
    landed = run_topics(spark, folder, "clickstream")["clickstream"]
    return ingest.landed_table(spark, "clickstream", landed).drop("ingested_at")


@query("str03_restart_from_checkpoint", "SELECT event_id, product_id, quantity_after FROM raw_inventory_updates")
def _(spark, folder):
    """The query is stopped and started again between slices; no event is lost or doubled."""
    topic, path = "inventory_updates", fresh_folder(spark, "str03-topic")
    target, progress = fresh_folder(spark, "str03"), fresh_folder(spark, "str03-progress")
    rows = topic_rows(RAW[topic](spark, folder), topic)
    for low, high in ((0, 1), (2, 3)):
        rows.where(C("partition").between(low, high)).write.mode("append").parquet(path)
        parsed = ingest.parse_topic(ingest.read_topic_files(spark, path), schemas.INVENTORY_UPDATES)
        ingest.land(parsed, target, progress, trigger=NOW).awaitTermination()
    return spark.read.parquet(target).select("event_id", "product_id", "quantity_after")


@query("str04_rate_limit", """
    SELECT count(*) AS events, TRUE AS several_batches, TRUE AS within_limit FROM raw_orders_stream""")
def _(spark, folder):
    """However many files wait, a batch takes two at most."""
    limit, path = 2, fresh_folder(spark, "str04-topic")
    rows = topic_rows(RAW["orders_stream"](spark, folder), "orders_stream")
    for part in range(SLICES):
        rows.where(C("partition") == part).write.mode("append").parquet(path)
    stream = ingest.read_topic_files(spark, path, files_per_trigger=limit)
    taken = stream.select("offset", C("_metadata.file_path").alias("file"))
    target = fresh_folder(spark, "str04")
    write = gate.gated_batch("taken", [], target, fresh_folder(spark, "str04-bad"))
    gate.land_gated(taken, fresh_folder(spark, "str04-progress"), write, NOW).awaitTermination()
    files = versions.read_current(spark, target).groupBy("batch_id", "file").agg(F.count("*").alias("events"))
    batches = files.groupBy("batch_id").agg(F.count("*").alias("files"), F.sum("events").alias("events"))
    return batches.agg(
        F.sum("events").alias("events"), (F.count("*") > 1).alias("several_batches"),
        (F.max("files") <= limit).alias("within_limit"))


@query("str05_hour_partitions", """
    SELECT year(kafka_timestamp) AS year, month(kafka_timestamp) AS month, day(kafka_timestamp) AS day,
           hour(kafka_timestamp) AS hour, count(*) AS events FROM raw_clickstream GROUP BY ALL""")
def _(spark, folder):
    landed = run_topics(spark, folder, "clickstream")["clickstream"]
    return spark.read.parquet(landed).groupBy(*schemas.HOUR_PARTITIONS).agg(F.count("*").alias("events"))


@query("str06_gated_batches", """
    SELECT event_id, kafka_partition AS batch_id, kafka_partition = 2 AS quarantined FROM raw_clickstream""")
def _(spark, folder):
    """A batch with a wrong value goes to quarantine as a whole, the others pass the suite and are loaded."""
    good, bad, progress = (fresh_folder(spark, f"str06-{part}") for part in ("good", "bad", "progress"))
    write = gate.gated_batch("clickstream", suites.clickstream(), good, bad)
    wrong = (C("kafka_partition") == 2) & (C("kafka_offset") % 100 == 0)

    def start(rows):
        clean = ingest.parse_topic(rows, schemas.CLICKSTREAM).withColumns({
            "event_type": F.trim("event_type"), "device_type": F.lower(F.trim("device_type")),
            "time_on_page_ms": F.when(wrong, -1).otherwise(C("time_on_page_ms")),
        })
        return gate.land_gated(clean.select(*schemas.landed("clickstream").names), progress, write, NOW)

    in_slices(spark, folder, "clickstream", start)
    loaded = spark.read.parquet(good).select("event_id", "batch_id", F.lit(False).alias("quarantined"))
    return loaded.unionByName(
        spark.read.parquet(bad).select("event_id", "batch_id", F.lit(True).alias("quarantined")))


@query("str07_landing_audit", " UNION ALL ".join(
    f"SELECT '{topic}' AS table_name, count(*) AS row_count, {len(schemas.landed(topic).names)} AS column_count, "
    f"'{schemas.landed(topic).simpleString()}' AS schema_text FROM raw_{topic}" for topic in schemas.TOPICS))
def _(spark, folder):
    result = None
    for topic, path in run_topics(spark, folder, *schemas.TOPICS).items():
        part = versions.audit(ingest.landed_table(spark, topic, path), topic)
        result = part if result is None else result.unionByName(part)
    return result


STREAMED = [name for name in MODEL_COLUMNS["int_streaming_orders_enriched"] if name not in ("ingested_at", "_loaded_at")]


@query("str08_stream_static_enrichment", f"""
    SELECT {rendered_sql(STREAMED)} FROM int_streaming_orders_enriched""")
def _(spark, folder):
    """The batch functions on a stream: parsed events staged, then joined to the customer table."""
    rows = ingest.read_topic_files(spark, store_topic(spark, folder, "orders_stream"), files_per_trigger=1)
    parsed = ingest.parse_topic(rows, schemas.ORDERS_STREAM).withColumns({
        "_loaded_at": F.current_timestamp(), "_source_file": F.lit("stream")})
    known = fresh_folder(spark, "str08-customers")  # written, so that a batch does not stage all customers again
    warehouse(spark, folder).stg_customers.select("customer_id", *intermediate.CUSTOMER_CONTEXT).write.parquet(known)
    enriched = intermediate.int_streaming_orders_enriched(
        staging.stg_orders_stream(parsed), spark.read.parquet(known), RULES.tier_floors)
    target, progress = fresh_folder(spark, "str08"), fresh_folder(spark, "str08-progress")
    writer = enriched.writeStream.format("parquet").option("path", target).option("checkpointLocation", progress)
    writer.trigger(**NOW).start().awaitTermination()
    return spark.read.parquet(target).select(*STREAMED)


@query("str09_sessions_of_landed_clicks", """
    SELECT session_id, user_id, total_events, unique_pages_viewed, funnel_stage, session_quality
    FROM int_clickstream_sessionized""")
def _(spark, folder):
    """Sessions over the table a stream has landed equal sessions over the raw events."""
    landed = run_topics(spark, folder, "clickstream")["clickstream"]
    clicks = ingest.landed_table(spark, "clickstream", landed).withColumns({
        "_loaded_at": C("ingested_at"), "_source_file": F.lit("stream")})
    return intermediate.int_clickstream_sessionized(staging.stg_clickstream(clicks)).select(
        "session_id", "user_id", "total_events", "unique_pages_viewed", "funnel_stage", "session_quality")


@query("str09_closed_sessions", f"""
    SELECT {rendered_sql(MODEL_COLUMNS['int_clickstream_sessionized'])} FROM int_clickstream_sessionized
    WHERE session_end + INTERVAL 1 DAY <= (SELECT max(event_timestamp) FROM stg_clickstream) - INTERVAL 1 HOUR""")
def _(spark, folder):
    """Sessions a stream has emitted because the watermark passed them by a day; those of the last day are open still."""
    clicks = ingest.parse_topic(ingest.read_topic_files(spark, store_topic(spark, folder, "clickstream")), schemas.CLICKSTREAM)
    staged = staging.stg_clickstream(clicks.withColumns({"_loaded_at": C("ingested_at"), "_source_file": F.lit("stream")}))
    target, progress = fresh_folder(spark, "str09"), fresh_folder(spark, "str09-progress")
    closing = sessions.closing_sessions(staged, "1 day", "1 hour", RULES.active_session_events)
    sessions.land_sessions(closing, target, progress, NOW).awaitTermination()
    return spark.read.parquet(target).select(*MODEL_COLUMNS["int_clickstream_sessionized"])


PATH_COLUMNS = [name for name in MODEL_COLUMNS["stg_clickstream"] if name not in ("ingested_at", "_loaded_at", "_source_file")]


@query("str10_topic_to_staging", f"SELECT {rendered_sql(PATH_COLUMNS)} FROM stg_clickstream")
def _(spark, folder):
    """The whole path of a topic: landed by a stream, discovered, staged behind the gate, published, staged as a model."""
    landed = run_topics(spark, folder, "clickstream")["clickstream"]
    layout = topic_load.TopicLayout(landed, *[fresh_folder(spark, f"str10-{part}") for part in ("table", "rejects", "manifest")])
    checks = [check for check in suites.clickstream() if check.kind in ("column_exists", "column_count", "not_null", "unique")]
    topic_load.load_new_files(spark, "clickstream", layout, SOURCES["clickstream"].schema, checks)
    return staging.stg_clickstream(spark.read.parquet(layout.table)).select(*PATH_COLUMNS)
