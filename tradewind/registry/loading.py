"""Sources (SRC), sinks and incremental state (SNK), history (SCD).

Queries that write do so into a fresh folder below the shared root and return what they read back.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions import money
from tradewind.operators import upsert
from tradewind.operators.keyed_table import KeyedTable
from tradewind.plans import batch_load, marts, staging, topic_load
from tradewind.plans.snapshot import KEPT, customer_segment_history, segment_state, snapshot_customer_segments
from tradewind.plans.warehouse import Warehouse, publish_marts, register_views
from tradewind.registry.contract import MODEL_COLUMNS, rendered_sql
from tradewind.registry.oracle import AS_OF, ISO, TABLES, latest, mean, variant
from tradewind.registry.register import Register
from tradewind.session import fresh_folder
from tradewind.sources import files, registry, sinks, state
from tradewind.sources.evolving import EvolvingTable
from tradewind.sources.extract import as_landed, as_text, since
from tradewind.sources.ranges import plan_ranges
from tradewind.sources.star_tables import RAW, warehouse

REGISTER = Register()
query = REGISTER.query
C = F.col

DAY = "strftime(_ingested_at, '%Y-%m-%d')"
RUN = datetime(2001, 7, 2, 2, 0)


def raw(spark, folder, name):
    return RAW[name](spark, folder)


def loads(spark, folder, name):
    """The first and second load of a batch table, as dates and rows."""
    rows = raw(spark, folder, name)
    for day in (date(2001, 7, 1), date(2001, 7, 2)):
        yield day, rows.where(F.to_date("_ingested_at") == F.lit(day)).drop("_ingested_at")


# ------------------------------------------------------------------ sources
@query("src01_full_extract", f"""
    SELECT order_item_id, order_id, product_id, quantity, {rendered_sql('unit_price discount subtotal created_at')}
    FROM raw_order_items""")
def _(spark, folder):
    """Tables without an extraction column are read in full."""
    return since(raw(spark, folder, "order_items").drop("_ingested_at"), "created_at", None)


@query("src01_extract_by_ranges", f"""
    SELECT order_id, customer_id, {rendered_sql('total_amount')}, 1 AS ranges FROM raw_orders_history""")
def _(spark, folder):
    """All orders, read range by range: the cuts come from the second load, a hot customer would be cut by amount."""
    orders = raw(spark, folder, "orders_history").withColumn("place", F.crc32("customer_id"))
    known = orders.where(C("_ingested_at") == F.lit("2001-07-02").cast("timestamp"))
    conditions = plan_ranges(known, "place", 8, tie="total_amount")
    parts = [orders.where(condition) for condition in conditions]
    found = sum(F.coalesce(F.expr(condition), F.lit(False)).cast("int") for condition in conditions)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result.select("order_id", "customer_id", "total_amount", found.alias("ranges"))


@query("src02_incremental_extract", f"""
    SELECT customer_id, email, {rendered_sql('created_at')} FROM raw_customers
    WHERE created_at > TIMESTAMP '1994-03-31'""")
def _(spark, folder):
    fresh = since(raw(spark, folder, "customers"), "created_at", datetime(1994, 3, 31))
    return fresh.select("customer_id", "email", "created_at")


@query("src03_dated_partition", """
    SELECT order_id, order_status, order_date AS order_text FROM raw_orders_history
    WHERE _ingested_at = TIMESTAMP '2001-07-02'""")
def _(spark, folder):
    base = fresh_folder(spark, "src03")
    for day, rows in loads(spark, folder, "orders_history"):
        sinks.write_dated(rows, base, day)
    return files.read_partition(spark, base, "2001-07-02").select(
        "order_id", "order_status", C("order_date").alias("order_text"))


@query("src04_all_files", """
    SELECT customer_id, 'orders' AS origin, order_id, NULL AS email FROM raw_orders_history UNION ALL
    SELECT customer_id, 'customers', NULL, email FROM raw_customers""")
def _(spark, folder):
    """Files of different columns below one folder, united by name; markers and logs are skipped."""
    base = fresh_folder(spark, "src04")
    orders = raw(spark, folder, "orders_history").select("customer_id", "order_id", F.lit("orders").alias("origin"))
    people = raw(spark, folder, "customers").select("email", "customer_id", F.lit("customers").alias("origin"))
    sinks.write_parquet(orders, f"{base}/orders")
    sinks.write_parquet(people, f"{base}/people")
    sinks.write_parquet(orders, f"{base}/_delta_log")
    return files.read_files(spark, base).select("customer_id", "origin", "order_id", "email")


@query("src05_newest_file", """
    SELECT customer_id, email FROM raw_customers WHERE _ingested_at = TIMESTAMP '2001-07-02'""")
def _(spark, folder):
    base = fresh_folder(spark, "src05")
    for day, rows in loads(spark, folder, "customers"):
        sinks.write_parquet(rows.repartition(4), f"{base}/run_date={day}")
    return files.read_newest(spark, base, schemas.CUSTOMERS).select("customer_id", "email")


def source_root(spark, folder, *names):
    root = fresh_folder(spark, "sources")
    for name in names:
        rows = sinks.align(raw(spark, folder, name), registry.SOURCES[name].schema, strict=False)
        sinks.write_parquet(rows, f"{root}/{name}")
    return root


# source -> a column that identifies its rows
SOURCE_KEYS = {**schemas.PRIMARY_KEYS, **dict.fromkeys(schemas.TOPICS, "event_id")}


@query("src09_declared_sources", " UNION ALL ".join(
    f"SELECT '{name}' AS source_name, {SOURCE_KEYS[name]} AS id FROM raw_{name}" for name in registry.SOURCES))
def _(spark, folder):
    """Every declared source read with its declared columns."""
    root = source_root(spark, folder, *registry.SOURCES)
    result = None
    for name in registry.SOURCES:
        part = registry.read_source(spark, root, name).select(
            F.lit(name).alias("source_name"), C(SOURCE_KEYS[name]).alias("id"))
        result = part if result is None else result.unionByName(part)
    return result


@query("src10_model_reference", """
    SELECT payment_method, order_value_tier, count(*) AS orders FROM mart_orders GROUP BY ALL""")
def _(spark, folder):
    orders = warehouse(spark, folder).model("mart_orders")
    return orders.groupBy("payment_method", "order_value_tier").agg(F.count("*").alias("orders"))


# ------------------------------------------------------------------ sinks
@query("snk01_write_parquet", f"""
    SELECT product_id, sku, {rendered_sql('unit_price created_at')}, is_active FROM raw_products""")
def _(spark, folder):
    path = fresh_folder(spark, "snk01")
    sinks.write_parquet(raw(spark, folder, "products"), path)
    return spark.read.parquet(path).select("product_id", "sku", "unit_price", "created_at", "is_active")


@query("snk02_run_time_layout", f"""
    SELECT supplier_id, email, 2001 AS run_year, 7 AS run_month, day(_ingested_at) AS run_day FROM raw_suppliers""")
def _(spark, folder):
    base = fresh_folder(spark, "snk02")
    for day, rows in loads(spark, folder, "suppliers"):
        sinks.write_run(rows, base, datetime(day.year, day.month, day.day, 2))
    return spark.read.parquet(base).select(
        "supplier_id", "email", C("year").alias("run_year"), C("month").alias("run_month"), C("day").alias("run_day"))


@query("snk03_rerun_replaces_date", f"""
    SELECT {DAY} AS loaded, count(*) AS row_count FROM raw_customers GROUP BY 1""")
def _(spark, folder):
    base = fresh_folder(spark, "snk03")
    for _ in range(2):
        for day, rows in loads(spark, folder, "customers"):
            sinks.write_dated(rows, base, day)
    written = spark.read.parquet(base)
    return written.groupBy(C("run_date").cast("string").alias("loaded")).agg(F.count("*").alias("row_count"))


@query("snk04_verify_written", "SELECT count(*) AS row_count, TRUE AS complete FROM raw_order_items")
def _(spark, folder):
    path = fresh_folder(spark, "snk04")
    items = raw(spark, folder, "order_items")
    sinks.write_parquet(items, path)
    expected = items.count()
    complete = sinks.holds(spark.read.parquet(path), expected)
    return spark.read.parquet(path).agg(F.count("*").alias("row_count"), F.lit(complete).alias("complete"))


@query("snk05_empty_extract_skipped", "SELECT count(*) AS row_count, FALSE AS wrote_again FROM raw_suppliers")
def _(spark, folder):
    layout = batch_load.Layout(*[fresh_folder(spark, "snk05") for _ in range(3)])
    rows = raw(spark, folder, "suppliers")
    batch_load.extract_increment(spark, rows, "suppliers", "created_at", layout, RUN)
    again = batch_load.extract_increment(spark, rows, "suppliers", "created_at", layout, datetime(2001, 7, 3))
    return files.read_files(spark, layout.landing, rows.schema).agg(
        F.count("*").alias("row_count"), F.lit(again).alias("wrote_again"))


MARKS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, max(created_at) AS last_extracted_at, count(*) AS last_row_count "
    f"FROM raw_{name}" for name in ("customers", "suppliers", "products")) + f"""
    UNION ALL SELECT 'orders_history', max(strptime(created_at, {ISO})), count(*) FROM raw_orders_history
    UNION ALL SELECT 'order_items', NULL, count(*) FROM raw_order_items"""


@query("snk06_advance_watermark", f"SELECT table_name, {rendered_sql('last_extracted_at')}, last_row_count FROM marks",
       {"marks": MARKS})
def _(spark, folder):
    """All batch tables; order items are read in full each time and have no mark."""
    marks = fresh_folder(spark, "snk06-state")
    for name in schemas.BATCH_TABLES:
        layout = batch_load.Layout(fresh_folder(spark, "snk06"), "", marks)
        column = None if name == "order_items" else "created_at"
        batch_load.extract_increment(spark, raw(spark, folder, name), name, column, layout, RUN)
    return state.watermarks(spark, marks).select("table_name", "last_extracted_at", "last_row_count")


@query("snk08_repeatable_load", """
    SELECT customer_id, email, strftime(_ingested_at, '%Y-%m-%d') AS load_day FROM raw_customers""")
def _(spark, folder):
    """Both dates loaded, the second one twice."""
    layout = batch_load.Layout(fresh_folder(spark, "snk08-landing"), fresh_folder(spark, "snk08-table"), "")
    (first, rows), (second, more) = loads(spark, folder, "customers")
    batch_load.load_dated(spark, rows, "customers", layout, first)
    batch_load.load_dated(spark, more, "customers", layout, second)
    batch_load.load_dated(spark, more, "customers", layout, second)
    return spark.read.parquet(layout.table).select(
        "customer_id", "email", C("load_date").cast("string").alias("load_day"))


@query("snk09_align_by_name", f"""
    SELECT supplier_id, supplier_name, NULL AS contact_name, email, phone, address, city, country,
           {rendered_sql('created_at')} FROM raw_suppliers""")
def _(spark, folder):
    """Columns in another order and case, one missing, one too many."""
    source = raw(spark, folder, "suppliers").drop("contact_name").withColumn("extra", F.lit(1))
    shuffled = source.select(*[C(name).alias(name.upper()) for name in reversed(source.columns)])
    return sinks.align(shuffled, schemas.SUPPLIERS)


@query("snk10_continue_on_error", """
    SELECT order_id, strftime(_ingested_at, '%Y-%m-%d') AS loaded,
           CASE WHEN order_date = 'not-a-date' THEN 'order_date' ELSE '' END AS rejected FROM raw_orders_history""")
def _(spark, folder):
    """Good rows and rejected rows together are all rows."""
    rows = as_text(raw(spark, folder, "orders_history"))
    schema = registry.SOURCES["orders_history"].schema
    good, bad = sinks.split_loadable(rows, schema)
    day = F.date_format("_ingested_at", "yyyy-MM-dd").alias("loaded")
    accepted = good.select("order_id", day, F.lit("").alias("rejected"))
    refused = bad.select("order_id", F.substring("_ingested_at", 1, 10).alias("loaded"), C("_rejected").alias("rejected"))
    return accepted.unionByName(refused)


@query("snk10_mixed_type_files", """
    SELECT event_id, CASE WHEN bad THEN NULL ELSE time_on_page_ms END AS time_on_page_ms, kafka_offset AS position,
           CASE WHEN bad THEN 'time_on_page_ms' ELSE '' END AS rejected
    FROM (SELECT *, kafka_partition = 1 AND kafka_offset % 50 = 0 AS bad FROM raw_clickstream)""")
def _(spark, folder):
    """Files of one topic with the same column as number, text and double: each row loads or is rejected."""
    layout = topic_layout(spark, "snk10")
    clicks = raw(spark, folder, "clickstream").select(*schemas.landed("clickstream").names)
    text = F.when(C("kafka_offset") % 50 == 0, "n/a").otherwise(C("time_on_page_ms").cast("string"))
    parts = {
        0: clicks, 1: clicks.withColumn("time_on_page_ms", text),
        2: clicks.withColumn("kafka_offset", C("kafka_offset").cast("double")).withColumnRenamed("page_url", "PAGE_URL"),
        3: clicks.withColumn("campaign", F.lit("spring")),
    }
    for number, rows in parts.items():
        sinks.write_parquet(rows.where(C("kafka_partition") == number), layout.landed, mode="append")
    topic_load.load_new_files(spark, "clickstream", layout, registry.SOURCES["clickstream"].schema)
    loaded = spark.read.parquet(layout.table).select("event_id", "time_on_page_ms", C("kafka_offset").alias("position"), F.lit("").alias("rejected"))
    refused = spark.read.parquet(layout.rejects).select(
        "event_id", F.lit(None).cast(loaded.schema["time_on_page_ms"].dataType).alias("time_on_page_ms"),
        C("kafka_offset").cast("bigint").alias("position"), C("_rejected").alias("rejected"))
    return loaded.unionByName(refused)


def topic_layout(spark, name):
    return topic_load.TopicLayout(*[fresh_folder(spark, f"{name}-{part}")
                                    for part in ("landed", "table", "rejects", "manifest")])


def land_clicks(spark, folder, layout, partition):
    clicks = raw(spark, folder, "clickstream").where(C("kafka_partition") == partition)
    sinks.write_parquet(clicks.select(*schemas.landed("clickstream").names), layout.landed, mode="append")


@query("snk11_discover_new_files", """
    SELECT event_id, session_id, time_on_page_ms, CASE WHEN kafka_partition = 0 THEN 0 ELSE 1 END AS load_id
    FROM raw_clickstream""")
def _(spark, folder):
    """Each load takes only the files that appeared since the one before."""
    layout = topic_layout(spark, "snk11")
    schema = registry.SOURCES["clickstream"].schema
    land_clicks(spark, folder, layout, 0)
    topic_load.load_new_files(spark, "clickstream", layout, schema)
    for partition in (1, 2, 3):
        land_clicks(spark, folder, layout, partition)
    topic_load.load_new_files(spark, "clickstream", layout, schema)
    topic_load.load_new_files(spark, "clickstream", layout, schema)
    return spark.read.parquet(layout.table).select("event_id", "session_id", "time_on_page_ms", "load_id")


@query("snk12_extend_loaded_set", " UNION ALL ".join(
    f"SELECT DISTINCT '{name}' AS topic, kafka_partition AS landed_partition, {load_id} AS load_id, FALSE AS repeated "
    f"FROM raw_{name}" for load_id, name in enumerate(("clickstream", "orders_stream"))))
def _(spark, folder):
    """Files of two topics land one after the other; each listing adds to the set only what is new."""
    landed, manifest = fresh_folder(spark, "snk12-landed"), fresh_folder(spark, "snk12")
    for load_id, name in enumerate(("clickstream", "orders_stream")):
        events = raw(spark, folder, name).withColumn("landed_partition", C("kafka_partition"))
        events.write.partitionBy("landed_partition").parquet(f"{landed}/{name}")
        new = state.pending(files.list_files(spark, landed), state.manifest(spark, manifest))
        state.mark_loaded(new, manifest, load_id)
    again = state.pending(files.list_files(spark, landed), state.manifest(spark, manifest))
    state.mark_loaded(again, manifest, 2)
    place = r"([a-z_]+)/landed_partition=(\d+)"
    return (
        state.manifest(spark, manifest)
        .groupBy(F.regexp_extract("path", place, 1).alias("topic"),
                 F.regexp_extract("path", place, 2).cast("int").alias("landed_partition"), "load_id")
        .agg((F.count("*") > F.count_distinct("path")).alias("repeated"))
    )


@query("snk13_create_table_if_missing", """
    SELECT supplier_id, country AS home, TRUE AS stamped FROM raw_suppliers""")
def _(spark, folder):
    location = fresh_folder(spark, "snk13")
    table = "suppliers_" + location.rsplit("-", 1)[1]
    schema = schemas.SUPPLIERS
    for _ in range(2):
        sinks.ensure_table(spark, table, schema, location)
    sinks.insert_rows(spark, sinks.align(raw(spark, folder, "suppliers"), schema), table)
    return spark.table(table).select("supplier_id", C("country").alias("home"), C("_ingested_at").isNotNull().alias("stamped"))


@query("snk14_views_and_tables", f"SELECT {rendered_sql(MODEL_COLUMNS['mart_customers'])} FROM mart_customers")
def _(spark, folder):
    """Staging and intermediate models as views, marts as tables that later marts read."""
    house = warehouse(spark, folder)
    register_views(house)
    published = publish_marts(spark, house, fresh_folder(spark, "snk14"), ("mart_orders", "mart_customers"))
    return published.model("mart_customers")


@query("snk15_schema_evolution", """
    SELECT event_id, session_id, CASE WHEN kafka_partition >= 2 THEN referrer END AS referrer FROM raw_clickstream""")
def _(spark, folder):
    """Later files have one column more; rows of earlier files read it as missing."""
    path = fresh_folder(spark, "snk15")
    clicks = raw(spark, folder, "clickstream")
    old, new = clicks.where("kafka_partition < 2"), clicks.where("kafka_partition >= 2")
    sinks.write_parquet(old.select("event_id", "session_id"), path, mode="append")
    sinks.write_parquet(new.select("event_id", "session_id", "referrer"), path, mode="append")
    return files.read_files(spark, path).select("event_id", "session_id", "referrer")


@query("snk15_schema_versions", """
    SELECT event_id, CAST(time_on_page_ms AS DOUBLE) AS millis, CASE WHEN kafka_partition >= 1 THEN referrer END AS referrer,
           CASE WHEN kafka_partition < 2 THEN session_id END AS session_id,
           least(kafka_partition, 2) AS written_under
    FROM raw_clickstream""")
def _(spark, folder):
    """Three generations of clicks: whole numbers become wider, then decimals, one column comes and one goes."""
    table, clicks = EvolvingTable(spark, fresh_folder(spark, "snk15-versions")), raw(spark, folder, "clickstream")
    shapes = (("int", ["session_id"]), ("bigint", ["session_id", "referrer"]), ("decimal(20,2)", ["referrer"]))
    for n, (kind, columns) in enumerate(shapes):
        part = clicks.where(F.least("kafka_partition", F.lit(2)) == n)
        table.append(part.select("event_id", C("time_on_page_ms").cast(kind).alias("time_on_page_ms"),
                                 "kafka_partition", *columns), f"generation {n}")
    return table.read().select("event_id", C("time_on_page_ms").alias("millis"), "referrer", "session_id",
                               F.least("kafka_partition", F.lit(2)).alias("written_under"))


@query("snk16_insert_if_absent", """
    SELECT customer_id, email FROM raw_customers
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at) = 1""")
def _(spark, folder):
    """Customers of one market first, then all loads of all customers: known ids keep their row."""
    people = raw(spark, folder, "customers").select("customer_id", "email", "state", "_ingested_at")
    present = people.where((C("state") == " MACHINERY") & (C("_ingested_at") == F.lit("2001-07-01").cast("timestamp")))
    return upsert.insert_if_absent(present, people, "customer_id", ["_ingested_at", "email"]).select(
        "customer_id", "email")


@query("snk17_refresh_order_totals", """
    SELECT order_id, CAST(coalesce(t, total_amount) AS DOUBLE) AS total FROM (
        SELECT order_id, total_amount, (SELECT round(sum(subtotal), 2) FROM stg_order_items i
                                        WHERE i.order_id = o.order_id) AS t FROM stg_orders_history o)""")
def _(spark, folder):
    house = warehouse(spark, folder)
    return upsert.refresh_order_totals(house.stg_orders_history, house.stg_order_items).select(
        "order_id", C("total_amount").alias("total"))


# Tables kept by key: batches rewrite only the buckets they change.
ITEM_TIES = ["order_id", "product_id", "quantity", "unit_price", "discount", "subtotal", "created_at"]


@query("win01_latest_by_loads", f"""
    SELECT order_item_id, order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS price, {rendered_sql('created_at')}
    FROM ({latest('raw_order_items', 'order_item_id', *ITEM_TIES)})""")
def _(spark, folder):
    """Latest order items from three loads merged one after another, the newest first."""
    table = KeyedTable(spark, fresh_folder(spark, "win01"), "order_item_id")
    items, second = raw(spark, folder, "order_items"), F.to_date("_ingested_at") == F.lit(date(2001, 7, 2))
    odd = F.coalesce(F.crc32("order_item_id") % 2 == 1, F.lit(False))
    for name, part in (("newest", second), ("odd", ~second & odd), ("even", ~second & ~odd)):
        table.merge_latest(items.where(part), name, ties=ITEM_TIES)
    return table.rows().select(
        "order_item_id", "order_id", "product_id", "quantity", C("unit_price").alias("price"), "created_at")


@query("snk16_insert_into_table", """
    SELECT customer_id, email, strftime(_ingested_at, '%Y-%m-%d') AS first_load FROM raw_customers
    WHERE customer_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at) = 1""")
def _(spark, folder):
    """Customers inserted load by load into a stored table; rows already present stay as they are."""
    table = KeyedTable(spark, fresh_folder(spark, "snk16"), "customer_id")
    people = raw(spark, folder, "customers").select("customer_id", "email", "_ingested_at")
    for day in (date(2001, 7, 1), date(2001, 7, 2)):
        table.insert_absent(people.where(F.to_date("_ingested_at") == F.lit(day)), f"{day}", ["_ingested_at", "email"])
    return table.rows().select("customer_id", "email", F.date_format("_ingested_at", "yyyy-MM-dd").alias("first_load"))


@query("snk17_update_table", """
    SELECT order_id, CAST(coalesce(t, total_amount) AS DOUBLE) AS total, t IS NOT NULL AND t IS DISTINCT FROM total_amount AS updated
    FROM (SELECT order_id, total_amount, (SELECT round(sum(subtotal), 2) FROM stg_order_items i
                                          WHERE i.order_id = o.order_id) AS t FROM stg_orders_history o)""")
def _(spark, folder):
    """Order totals refreshed from their items inside a stored table, and which rows that changed."""
    house, table = warehouse(spark, folder), KeyedTable(spark, fresh_folder(spark, "snk17"), "order_id")
    table.insert_absent(house.stg_orders_history.select("order_id", "customer_id", "total_amount"), "orders", ["total_amount"])
    totals = house.stg_order_items.groupBy("order_id").agg(money.total(C("subtotal")).alias("total_amount"))
    updated = table.update(totals, "totals", ["total_amount"]).select("order_id", F.lit(True).alias("updated"))
    return table.rows().join(updated, "order_id", "left").select(
        "order_id", C("total_amount").alias("total"), F.coalesce("updated", F.lit(False)).alias("updated"))


# ------------------------------------------------------------------ history
# The mart at three dates: order history up to that date, customers of one market leaving at the end.
STATES = (datetime(1999, 1, 1), datetime(2000, 1, 1), datetime(2001, 8, 2))


def history_tables(spark, folder):
    """What the marts at all dates are made of, written once: staged customers, and orders with their line summary."""
    house, known = warehouse(spark, folder), {}
    for name, rows in (("stg_customers", house.stg_customers),
                       ("customer_orders", house.customer_orders.select(*marts.CUSTOMER_ORDER_COLUMNS))):
        path = fresh_folder(spark, f"history-{name}")
        rows.write.parquet(path)
        known[name] = spark.read.parquet(path)
    return Warehouse(house.raw, house.rules, known, house.ties)


def mart_at(tables, number):
    """The customer mart as of one of the dates, from the orders placed before it. An order's summary is the same at all
    dates."""
    as_of, known = STATES[number], dict(tables.published)
    known["customer_orders"] = known["customer_orders"].where(C("order_date") < F.lit(as_of))
    if number == 2:
        known["stg_customers"] = known["stg_customers"].where(C("state") != "HOUSEHOLD")
    return Warehouse(tables.raw, replace(tables.rules, as_of=as_of), known, tables.ties).mart_customers


def mart_sql(number):
    """The tables that lead to the mart, once more for each date."""
    time = f"TIMESTAMP '{STATES[number]:%Y-%m-%d}'"
    cut = {"stg_orders_history": f"SELECT * FROM stg_orders_history WHERE order_date < {time}"}
    if number == 2:
        cut["stg_customers"] = "SELECT * FROM stg_customers WHERE state <> 'HOUSEHOLD'"
    return variant("mart_customers", f"at_{number}", cut, {AS_OF: time})


HISTORY = {}
for number, as_of in enumerate(STATES):
    HISTORY |= mart_sql(number)
    HISTORY[f"state_{number}"] = (f"SELECT {', '.join(KEPT)}, TIMESTAMP '{as_of:%Y-%m-%d}' AS run_at "
                                  f"FROM mart_customers_at_{number}")
# Versions by gaps and islands: a row opens a version when a checked column differs from the run before.
HISTORY["runs"] = "SELECT * FROM state_0 UNION ALL SELECT * FROM state_1 UNION ALL SELECT * FROM state_2"
HISTORY["openings"] = """
    SELECT *, lag(run_at) OVER w IS NULL
              OR lag((customer_segment, lifetime_value, total_orders, is_active_customer)) OVER w
                 IS DISTINCT FROM (customer_segment, lifetime_value, total_orders, is_active_customer) AS opens
    FROM runs WINDOW w AS (PARTITION BY customer_id ORDER BY run_at)"""
HISTORY["versions"] = """
    SELECT customer_id, full_name, email, customer_segment, lifetime_value, total_orders, is_active_customer,
           days_since_last_order, preferred_category, run_at AS snapshotted_at, run_at AS valid_from, run_at AS updated_at,
           md5(customer_id || '|' || strftime(run_at, '%Y-%m-%d %H:%M:%S')) AS scd_id,
           coalesce(lead(run_at) OVER (PARTITION BY customer_id ORDER BY run_at),
                    CASE WHEN customer_id NOT IN (SELECT customer_id FROM state_2) THEN TIMESTAMP '2001-08-02' END)
               AS valid_to
    FROM openings WHERE opens"""
HISTORY_COLUMNS = [*KEPT, "snapshotted_at", "scd_id", "updated_at", "valid_from", "valid_to"]


def snapshot_runs(spark, tables, close_missing=True):
    """The three runs over one stored history, as a scheduled job would; returns its folder."""
    root = fresh_folder(spark, "segments")
    for number, as_of in enumerate(STATES):
        snapshot_customer_segments(spark, root, mart_at(tables, number), as_of, close_missing)
    return root


@query("scd01_segment_history", f"SELECT {rendered_sql(HISTORY_COLUMNS)} FROM versions", HISTORY)
def _(spark, folder):
    return customer_segment_history(spark, snapshot_runs(spark, history_tables(spark, folder))).select(*HISTORY_COLUMNS)


@query("scd02_closed_when_missing", f"""
    SELECT customer_id, {rendered_sql('valid_from valid_to')} FROM versions
    WHERE customer_id NOT IN (SELECT customer_id FROM state_2) AND valid_to = TIMESTAMP '2001-08-02'""", HISTORY)
def _(spark, folder):
    tables = history_tables(spark, folder)
    history = customer_segment_history(spark, snapshot_runs(spark, tables))
    still = mart_at(tables, 2).select("customer_id")
    gone = history.join(still, "customer_id", "left_anti")
    return gone.where(C("valid_to") == F.lit(STATES[2])).select("customer_id", "valid_from", "valid_to")


@query("scd03_segment_projection", f"""
    SELECT {rendered_sql(list(KEPT))}, '2001-08-02 00:00:00.000000' AS snapshotted_at FROM mart_customers""")
def _(spark, folder):
    return segment_state(warehouse(spark, folder).mart_customers, STATES[2])


@query("join15_history_match", f"""
    SELECT coalesce(a.customer_id, b.customer_id) AS customer_id,
           CASE WHEN b.customer_id IS NULL THEN 'missing' WHEN a.customer_id IS NULL THEN 'new'
                WHEN (a.customer_segment, a.lifetime_value, a.total_orders, a.is_active_customer) IS DISTINCT FROM
                     (b.customer_segment, b.lifetime_value, b.total_orders, b.is_active_customer) THEN 'changed'
                ELSE 'same' END AS outcome
    FROM state_1 a FULL JOIN state_2 b ON a.customer_id = b.customer_id""", HISTORY)
def _(spark, folder):
    """What the history match decides per customer."""
    root, tables = fresh_folder(spark, "join15"), history_tables(spark, folder)
    snapshot_customer_segments(spark, root, mart_at(tables, 1), STATES[1])
    changes = snapshot_customer_segments(spark, root, mart_at(tables, 2), STATES[2])
    outcomes = changes.select(F.coalesce("old.customer_id", "new.customer_id").alias("customer_id"), C("_outcome").alias("outcome"))
    versions = customer_segment_history(spark, root).select("customer_id").distinct()
    return versions.join(outcomes, "customer_id", "left").select("customer_id", F.coalesce("outcome", F.lit("same")).alias("outcome"))


@query("mdl11_customer_segments_snapshot", f"""
    SELECT {rendered_sql(HISTORY_COLUMNS)}, valid_to IS NULL AS is_current FROM versions""", HISTORY)
def _(spark, folder):
    """All columns of the history of the customer mart."""
    return customer_segment_history(spark, snapshot_runs(spark, history_tables(spark, folder))).select(
        *HISTORY_COLUMNS, C("valid_to").isNull().alias("is_current"))
