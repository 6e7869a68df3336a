"""Scalar functions (FN), macros (MAC), projections (PRJ) and predicates (FLT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions import classify, keys, money, temporal, text
from tradewind.plans.intermediate import sold_lines
from tradewind.plans.warehouse import Warehouse
from tradewind.registry.contract import rendered_sql
from tradewind.registry.oracle import AS_OF as AS_OF_SQL, HEALTH, ISO, TIER, mean
from tradewind.registry.register import Register
from tradewind.session import fresh_folder, shuffles_removed
from tradewind.sources import star_tables
from tradewind.sources.extract import as_landed, as_text
from tradewind.sources.star_tables import AS_OF, RULES, read, warehouse
from tradewind.streaming.ingest import parse_topic

REGISTER = Register()
query = REGISTER.query

C = F.col


def raw(spark, folder, name):
    return star_tables.RAW[name](spark, folder)


# ------------------------------------------------------------------ scalar functions
@query("fn01_trim_upper_lower", """
    SELECT customer_id, strftime(_ingested_at, '%Y-%m-%d') AS loaded, trim(first_name) AS trimmed,
           upper(trim(email)) AS uppered, lower(trim(email)) AS lowered FROM raw_customers""")
def _(spark, folder):
    return raw(spark, folder, "customers").select(
        "customer_id", F.date_format("_ingested_at", "yyyy-MM-dd").alias("loaded"),
        text.trimmed("first_name").alias("trimmed"), text.uppered("email").alias("uppered"),
        text.lowered("email").alias("lowered"))


@query("fn02_concat_names", """
    SELECT customer_id, strftime(_ingested_at, '%Y-%m-%d') AS loaded,
           coalesce(trim(CASE WHEN state <> ' HOUSEHOLD' THEN first_name END), '') || ' '
               || coalesce(trim(last_name), '') AS full_name FROM raw_customers""")
def _(spark, folder):
    """Customers of one market segment have no first name here; the blank stays."""
    first = F.when(C("state") != " HOUSEHOLD", C("first_name"))
    return raw(spark, folder, "customers").withColumn("first_name", first).select(
        "customer_id", F.date_format("_ingested_at", "yyyy-MM-dd").alias("loaded"),
        text.full_name("first_name", "last_name").alias("full_name"))


@query("fn03_coalesce_discount", f"""
    SELECT order_item_id, product_id, quantity, {rendered_sql('unit_price')},
           CAST(coalesce(discount, 0) AS DOUBLE) AS rate FROM raw_order_items""")
def _(spark, folder):
    return raw(spark, folder, "order_items").select(
        "order_item_id", "product_id", "quantity", "unit_price", money.fraction("discount").alias("rate"))


@query("fn04_round_half_away", """
    SELECT order_item_id, product_id, quantity, unit_price AS p, sum_up, sum_down FROM (
        SELECT order_item_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(round(unit_price, 1) AS DOUBLE) AS sum_up, CAST(round(-unit_price, 1) AS DOUBLE) AS sum_down
        FROM raw_order_items)""")
def _(spark, folder):
    return raw(spark, folder, "order_items").select(
        "order_item_id", "product_id", "quantity", C("unit_price").alias("p"),
        F.round("unit_price", 1).alias("sum_up"), F.round(-C("unit_price"), 1).alias("sum_down"))


@query("fn05_abs", "SELECT event_id, warehouse_id, abs(quantity_change) AS units FROM stg_inventory_updates")
def _(spark, folder):
    return warehouse(spark, folder).stg_inventory_updates.select(
        "event_id", "warehouse_id", F.abs("quantity_change").alias("units"))


@query("fn06_decimal_division", f"""
    SELECT event_id, {mean('total_amount', 'item_count', 4)} AS per_item FROM stg_orders_stream""")
def _(spark, folder):
    events = warehouse(spark, folder).stg_orders_stream
    return events.select("event_id", money.average(C("total_amount"), C("item_count"), 4).alias("per_item"))


@query("fn07_case_classes", f"""
    SELECT order_id, {TIER} AS tier, CASE payment_method WHEN 'PAYPAL' THEN 1 WHEN 'CRYPTO' THEN 2 ELSE 0 END AS code
    FROM stg_orders_history""")
def _(spark, folder):
    method = C("payment_method")
    return warehouse(spark, folder).stg_orders_history.select(
        "order_id", classify.order_value_tier(C("total_amount"), RULES.tier_floors).alias("tier"),
        F.when(method == "PAYPAL", 1).when(method == "CRYPTO", 2).otherwise(0).alias("code"))


@query("fn08_in_list", """
    SELECT event_id, user_id IS NULL OR lower(trim(user_id)) IN ('null', 'guest', '') AS anonymous
    FROM raw_clickstream""")
def _(spark, folder):
    return raw(spark, folder, "clickstream").select("event_id", text.is_anonymous("user_id").alias("anonymous"))


@query("fn09_tolerant_timestamp", """
    SELECT event_id, strftime(TRY_CAST(event_timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS parsed
    FROM raw_clickstream""")
def _(spark, folder):
    return raw(spark, folder, "clickstream").select("event_id", temporal.parse_time("event_timestamp").alias("parsed"))


@query("fn10_tolerant_timestamp_of_any_type", """
    SELECT order_id, strftime(_ingested_at, '%Y-%m-%d') AS loaded,
           strftime(TRY_CAST(order_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS from_text,
           strftime(_ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS from_time FROM raw_orders_history""")
def _(spark, folder):
    return raw(spark, folder, "orders_history").select(
        "order_id", F.date_format("_ingested_at", "yyyy-MM-dd").alias("loaded"),
        temporal.parse_time("order_date").alias("from_text"), temporal.parse_time("_ingested_at").alias("from_time"))


@query("fn11_days_between", """
    SELECT event_id, date_diff('day', ts, ts + INTERVAL 10 HOUR) AS forward,
           date_diff('day', ts + INTERVAL 30 HOUR, ts) AS backward FROM events""")
def _(spark, folder):
    time = C("ts").cast("timestamp")
    later = lambda hours: time + F.make_dt_interval(hours=F.lit(hours))
    return read(spark, folder, "events").select(
        "event_id", temporal.days_between(time, later(10)).alias("forward"),
        temporal.days_between(later(30), time).alias("backward"))


@query("fn12_seconds_between", """
    SELECT event_id, date_diff('second', ts, ts + INTERVAL 500 MILLISECOND) AS half_second,
           date_diff('second', date_trunc('day', ts), ts) AS second_of_day FROM events""")
def _(spark, folder):
    time = C("ts").cast("timestamp")
    later = time + F.make_dt_interval(secs=F.lit(0.5).cast("decimal(18,6)"))
    return read(spark, folder, "events").select(
        "event_id", temporal.seconds_between(time, later).alias("half_second"),
        temporal.seconds_between(F.date_trunc("day", time), time).alias("second_of_day"))


@query("fn13_date_of", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(spark, folder):
    return read(spark, folder, "events").select("event_id", F.to_date("ts").alias("day"))


@query("fn14_date_trunc", """
    SELECT event_id, strftime(date_trunc('week', ts), '%Y-%m-%d %H:%M:%S.%f') AS week,
           strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S.%f') AS month,
           strftime(date_trunc('year', ts), '%Y-%m-%d %H:%M:%S.%f') AS year FROM events""")
def _(spark, folder):
    return read(spark, folder, "events").select(
        "event_id", *[F.date_trunc(unit, "ts").alias(unit) for unit in ("week", "month", "year")])


@query("fn15_date_parts", """
    SELECT event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h, dayofweek(ts) + 1 AS weekday
    FROM events""")
def _(spark, folder):
    return read(spark, folder, "events").select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"),
        F.hour("ts").alias("h"), F.dayofweek("ts").alias("weekday"))


@query("fn16_as_of_time", f"""
    SELECT customer_id, date_diff('day', max(order_date), {AS_OF_SQL}) AS idle_days
    FROM stg_orders_history GROUP BY customer_id""")
def _(spark, folder):
    last = warehouse(spark, folder).stg_orders_history.groupBy("customer_id").agg(F.max("order_date").alias("last"))
    idle = temporal.days_between(C("last"), F.lit(AS_OF).cast("timestamp"))
    return last.select("customer_id", idle.alias("idle_days"))


def broken_json(rows, modulus):
    """Cut the payload of every ``modulus``-th message in half."""
    value = C("value").cast("string")
    cut = F.when(C("offset") % modulus == 0, F.substring(value, 1, 20)).otherwise(value)
    return rows.withColumn("value", cut.cast("binary"))


@query("fn17_from_json", """
    SELECT kafka_offset, kafka_partition, CASE WHEN ok THEN event_id END AS event_id,
           CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN time_on_page_ms END AS time_on_page_ms
    FROM (SELECT *, kafka_offset % 7 <> 0 AS ok FROM raw_clickstream)""")
def _(spark, folder):
    from tradewind.registry.topics import topic_rows

    messages = broken_json(topic_rows(raw(spark, folder, "clickstream"), "clickstream"), 7)
    return parse_topic(messages, schemas.CLICKSTREAM).select(
        "kafka_offset", "kafka_partition", "event_id", "user_id", "time_on_page_ms")


@query("fn18_hour_partitions", """
    SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour FROM events""")
def _(spark, folder):
    return read(spark, folder, "events").withColumns(temporal.hour_partitions(C("ts"))).select(
        "event_id", *schemas.HOUR_PARTITIONS)


@query("fn19_binary_to_text", "SELECT event_id, props AS payload, event_type FROM events")
def _(spark, folder):
    stored = read(spark, folder, "events").withColumn("body", F.encode("props", "UTF-8"))
    return stored.select("event_id", C("body").cast("string").alias("payload"), "event_type")


@query("fn20_address_parts", """
    SELECT order_id, CASE WHEN len(parts) > 1 THEN substr(trim(parts[2]), 1, 50) ELSE 'Unknown' END AS city,
           CASE WHEN len(parts) > 2 THEN substr(trim(parts[-1]), 1, 50) ELSE 'US' END AS country
    FROM (SELECT order_id, string_split(coalesce(shipping_address, ''), ',') AS parts FROM stg_orders_history)""")
def _(spark, folder):
    return warehouse(spark, folder).stg_orders_history.select(
        "order_id", text.city_of("shipping_address").alias("city"), text.country_of("shipping_address").alias("country"))


@query("fn21_url_template", """
    SELECT event_id, '/products/' || coalesce(product_id, 'unknown') || '?ref=search' AS url FROM raw_clickstream""")
def _(spark, folder):
    url = text.fill_template(F.lit("/products/{id}?ref=search"), C("product_id"))
    return raw(spark, folder, "clickstream").select("event_id", url.alias("url"))


@query("fn22_sku_prefix", r"""
    SELECT p_partkey, regexp_replace(upper(p_name), '([A-Z])[^ ]* ?', '\1', 'g')
           || '-' || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(5, length(CAST(p_partkey AS VARCHAR))) AS INT), '0') AS prefix
    FROM part""")
def _(spark, folder):
    return read(spark, folder, "part").select("p_partkey", text.sku_prefix(C("p_name"), C("p_partkey")).alias("prefix"))


@query("fn23_regex_match", r"""
    SELECT customer_id, strftime(_ingested_at, '%Y-%m-%d') AS loaded,
           regexp_matches(trim(email), '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$') AS trimmed_ok,
           regexp_matches(email, '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$') AS raw_ok,
           regexp_matches(customer_id, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$') AS uuid_ok
    FROM raw_customers""")
def _(spark, folder):
    return raw(spark, folder, "customers").select(
        "customer_id", F.date_format("_ingested_at", "yyyy-MM-dd").alias("loaded"),
        F.trim("email").rlike(text.EMAIL_PATTERN).alias("trimmed_ok"),
        C("email").rlike(text.EMAIL_PATTERN).alias("raw_ok"),
        C("customer_id").rlike(text.UUID_PATTERN).alias("uuid_ok"))


@query("fn24_regex_replace_offset", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM events""")
def _(spark, folder):
    plain = F.date_format(C("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxx")
    return read(spark, folder, "events").select("event_id", text.colon_offset(plain).alias("iso"))


@query("fn25_to_json", """
    SELECT event_id, to_json({'event_id': event_id, 'user_id': user_id, 'category': category,
                              'time_on_page_ms': time_on_page_ms, 'source': source}) AS payload
    FROM raw_clickstream""")
def _(spark, folder):
    event = F.struct("event_id", "user_id", "category", "time_on_page_ms", "source")
    return raw(spark, folder, "clickstream").select(
        "event_id", F.to_json(event, {"ignoreNullFields": "false"}).alias("payload"))


# ------------------------------------------------------------------ macros
@query("mac01_cents_to_dollars", f"""
    SELECT order_item_id, product_id, quantity, {mean('cents', '100', 2)} AS dollars,
           {mean('cents', '100', 1)} AS tenths
    FROM (SELECT *, CAST(unit_price * 100 AS BIGINT) AS cents FROM raw_order_items)""")
def _(spark, folder):
    cents = (C("unit_price") * 100).cast("bigint")
    return raw(spark, folder, "order_items").select(
        "order_item_id", "product_id", "quantity", money.cents_to_dollars(cents).alias("dollars"),
        money.cents_to_dollars(cents, 1).alias("tenths"))


@query("mac02_date_spine", f"""
    SELECT event_id, {rendered_sql('date_day date_week date_month date_year')},
           year_num, month_num, day_num, day_of_week, day_name
    FROM (SELECT event_id, CAST(ts AS DATE) AS date_day, date_trunc('week', ts) AS date_week,
                 date_trunc('month', ts) AS date_month, date_trunc('year', ts) AS date_year, year(ts) AS year_num,
                 month(ts) AS month_num, day(ts) AS day_num, dayofweek(ts) + 1 AS day_of_week, dayname(ts) AS day_name
          FROM events)""")
def _(spark, folder):
    spine = temporal.date_spine(C("ts").cast("timestamp"))
    return read(spark, folder, "events").select("event_id", *[column.alias(name) for name, column in spine.items()])


@query("mac03_surrogate_key", """
    SELECT event_id, md5(coalesce(user_id, '_dbt_utils_surrogate_key_null_') || '-' || session_id || '-'
                         || coalesce(category, '_dbt_utils_surrogate_key_null_')) AS key
    FROM raw_clickstream""")
def _(spark, folder):
    return raw(spark, folder, "clickstream").select(
        "event_id", keys.surrogate_key("user_id", "session_id", "category").alias("key"))


@query("mac04_layer_schema", """
    SELECT layer, "schema", rows FROM (
        SELECT 'staging' AS layer, 'STAGING' AS "schema", count(*) AS rows FROM stg_suppliers UNION ALL
        SELECT 'intermediate', 'STAGING', count(*) FROM int_order_lines UNION ALL
        SELECT 'marts', 'MARTS', count(*) FROM mart_revenue_daily UNION ALL
        SELECT 'none', 'RAW', count(*) FROM raw_suppliers)""")
def _(spark, folder):
    """A model of each layer written to the folder of its schema and read back; without a layer, the default. What the
    order lines are joined from is written first: its shuffles are gone before those of the joins begin."""
    root, house = fresh_folder(spark, "mac04"), warehouse(spark, folder)
    models = {"staging": "stg_suppliers", "intermediate": "int_order_lines", "marts": "mart_revenue_daily"}
    published, result = {}, None

    def put(rows, path):
        with shuffles_removed(spark):
            rows.write.option("compression", "zstd").parquet(f"{root}/{path}")
        return spark.read.parquet(f"{root}/{path}")

    for name in ("stg_order_items", "stg_orders_history"):
        published[name] = put(house.model(name), f"{keys.schema_name(keys.LAYER_SCHEMAS['staging'], 'RAW')}/{name}")
    for layer in (*models, "none"):
        built = Warehouse(house.raw, house.rules, published, house.ties)
        rows = built.model(models[layer]) if layer in models else raw(spark, folder, "suppliers")
        schema = keys.schema_name(keys.LAYER_SCHEMAS.get(layer), "RAW")
        written = put(rows, f"{schema}/{layer}")
        published[models.get(layer)] = written  # later layers read it
        part = written.agg(F.count("*").alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(schema).alias("schema"), "rows")
        result = part if result is None else result.unionByName(part)
    return result


# ------------------------------------------------------------------ projections
@query("prj01_star_plus_column", f"""
    SELECT {rendered_sql('order_id customer_id order_status payment_method shipping_address total_amount order_date'
                         ' shipped_date delivered_date created_at _ingested_at')},
           date_diff('day', shipped_date, delivered_date) AS days_in_transit FROM stg_orders_history""")
def _(spark, folder):
    orders = warehouse(spark, folder).stg_orders_history.drop("days_to_ship")
    return orders.withColumn("days_in_transit", temporal.days_between(C("shipped_date"), C("delivered_date")))


@query("prj02_rename", f"""
    SELECT event_id, source AS event_source, {rendered_sql('ingested_at')} FROM raw_inventory_updates""")
def _(spark, folder):
    return raw(spark, folder, "inventory_updates").select("event_id", C("source").alias("event_source"), "ingested_at")


@query("prj03_flatten_struct", f"""
    SELECT kafka_offset, kafka_partition, event_id, product_id, quantity_after, triggered_by
    FROM raw_inventory_updates""")
def _(spark, folder):
    fields = [name for name in schemas.INVENTORY_UPDATES.names]
    nested = raw(spark, folder, "inventory_updates").select(
        "kafka_offset", "kafka_partition", F.struct(*fields).alias("data"))
    return nested.select("kafka_offset", "kafka_partition", "data.*").select(
        "kafka_offset", "kafka_partition", "event_id", "product_id", "quantity_after", "triggered_by")


@query("prj04_strict_casts", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INT) AS quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(l_partkey AS VARCHAR) AS part,
           CAST(CAST(l_quantity AS INT) AS DOUBLE) / 4 AS quarter FROM lineitem""")
def _(spark, folder):
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C("l_quantity").cast("int").alias("quantity"),
        C("l_extendedprice").cast("decimal(12,2)").alias("price"), C("l_partkey").cast("string").alias("part"),
        (C("l_quantity").cast("int").cast("double") / 4).alias("quarter"))


@query("prj05_all_text", """
    SELECT event_id, user_id, CAST(time_on_page_ms AS VARCHAR) AS time_on_page_ms, category, referrer
    FROM raw_clickstream""")
def _(spark, folder):
    """Text form of every column; a missing value stays missing."""
    return as_text(raw(spark, folder, "clickstream")).select(
        "event_id", "user_id", "time_on_page_ms", "category", "referrer")


@query("prj06_iso_times", f"""
    SELECT customer_id, strftime(created_at, {ISO}) AS created_text, strftime(updated_at, {ISO}) AS updated_text,
           strftime(_ingested_at, {ISO}) AS loaded_text FROM raw_customers""")
def _(spark, folder):
    return as_landed(raw(spark, folder, "customers")).select(
        "customer_id", C("created_at").alias("created_text"), C("updated_at").alias("updated_text"),
        C("_ingested_at").alias("loaded_text"))


@query("prj07_text_to_time", f"""
    SELECT order_id, strftime(_ingested_at, '%Y-%m-%d') AS loaded,
           strftime(TRY_CAST(order_date AS TIMESTAMP), {ISO}) AS order_time,
           strftime(TRY_CAST(delivered_date AS TIMESTAMP), {ISO}) AS delivered_time,
           TRY_CAST(order_date AS TIMESTAMP) IS NULL AS unreadable FROM raw_orders_history""")
def _(spark, folder):
    order, delivered = temporal.parse_time("order_date"), temporal.parse_time("delivered_date")
    return raw(spark, folder, "orders_history").select(
        "order_id", F.date_format("_ingested_at", "yyyy-MM-dd").alias("loaded"),
        temporal.iso_text(order).alias("order_time"), temporal.iso_text(delivered).alias("delivered_time"),
        order.isNull().alias("unreadable"))


@query("prj08_generated_subtotal", """
    SELECT order_item_id, product_id, quantity, CAST(subtotal AS DOUBLE) AS derived FROM raw_order_items""")
def _(spark, folder):
    return raw(spark, folder, "order_items").select(
        "order_item_id", "product_id", "quantity",
        money.line_subtotal("quantity", "unit_price", "discount").alias("derived"))


# ------------------------------------------------------------------ predicates
@query("flt01_key_not_null", "SELECT event_id, user_id FROM raw_clickstream WHERE user_id IS NOT NULL")
def _(spark, folder):
    return raw(spark, folder, "clickstream").where(C("user_id").isNotNull()).select("event_id", "user_id")


@query("flt02_readable_time", """
    SELECT event_id, event_timestamp AS original FROM raw_orders_stream
    WHERE TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL""")
def _(spark, folder):
    readable = raw(spark, folder, "orders_stream").where(temporal.parse_time("event_timestamp").isNotNull())
    return readable.select("event_id", C("event_timestamp").alias("original"))


@query("flt03_kept_sales", """
    SELECT order_item_id, order_status, CAST(line_revenue AS DOUBLE) AS line_revenue FROM int_order_lines
    WHERE NOT is_cancelled AND NOT is_refunded""")
def _(spark, folder):
    house = warehouse(spark, folder)
    lines = sold_lines(house.stg_order_items, house.stg_orders_history)
    return lines.where(classify.kept_sale()).select("order_item_id", "order_status", "line_revenue")


@query("flt04_active_products", f"""
    SELECT product_id, sku, stock_quantity, {HEALTH.format('stock_quantity')} AS health
    FROM stg_products WHERE is_active""")
def _(spark, folder):
    return warehouse(spark, folder).stg_products.where("is_active").select(
        "product_id", "sku", "stock_quantity", classify.stock_health(C("stock_quantity")).alias("health"))


@query("flt05_without_load_date", """
    SELECT customer_id, email FROM raw_customers WHERE CAST(_ingested_at AS DATE) <> DATE '2001-07-02'""")
def _(spark, folder):
    """What is left after the rows of one load date are deleted."""
    loaded = raw(spark, folder, "customers")
    return loaded.where(F.to_date("_ingested_at") != F.lit("2001-07-02").cast("date")).select("customer_id", "email")
