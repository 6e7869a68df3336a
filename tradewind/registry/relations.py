"""Joins (JOIN), aggregations (AGG), windows (WIN), order and limit (SRT), set operations (SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions import classify, money, temporal
from tradewind.operators import aggregates, feeds, ranking, upsert
from tradewind.operators.dedup import keep_latest
from tradewind.operators.joins import known_key_share, lookup, orphans
from tradewind.plans import intermediate, marts, staging
from tradewind.registry.contract import rendered_sql
from tradewind.registry.oracle import commonest, latest, mean, units
from tradewind.registry.register import Register
from tradewind.session import fresh_folder
from tradewind.sources import state
from tradewind.sources.files import list_files
from tradewind.sources.star_tables import RAW, read, warehouse

REGISTER = Register()
query = REGISTER.query
C = F.col


def raw(spark, folder, name):
    return RAW[name](spark, folder)


# ------------------------------------------------------------------ joins
@query("join01_items_inner_orders", f"""
    SELECT order_item_id, order_id, o.customer_id, {rendered_sql('order_date line_revenue')}
    FROM (SELECT order_item_id, i.order_id, o.customer_id, order_date,
                 effective_unit_price * quantity AS line_revenue
          FROM stg_order_items i JOIN stg_orders_history o USING (order_id)) o""")
def _(spark, folder):
    house = warehouse(spark, folder)
    return intermediate.sold_lines(house.stg_order_items, house.stg_orders_history).select(
        "order_item_id", "order_id", "customer_id", "order_date", "line_revenue")


@query("join02_items_left_products", """
    SELECT order_item_id, product_id, product_name, category
    FROM stg_order_items LEFT JOIN stg_products USING (product_id)""")
def _(spark, folder):
    house = warehouse(spark, folder)
    columns = {"product_name": "product_name", "category": "category"}
    return lookup(house.stg_order_items, house.stg_products, "product_id", "product_id", columns).select(
        "order_item_id", "product_id", *columns)


@query("join03_orders_left_customers", """
    SELECT order_id, customer_id, full_name, c.country AS home
    FROM stg_orders_history LEFT JOIN stg_customers c USING (customer_id)""")
def _(spark, folder):
    house = warehouse(spark, folder)
    return lookup(house.stg_orders_history, house.stg_customers, "customer_id", "customer_id",
                  {"full_name": "full_name", "country": "home"}, spread_by=("order_id",)).select(
        "order_id", "customer_id", "full_name", "home")


@query("join04_events_left_customers", """
    SELECT event_id, e.customer_id, c.customer_id IS NOT NULL AS matched, full_name
    FROM stg_orders_stream e LEFT JOIN stg_customers c ON e.customer_id = c.customer_id""")
def _(spark, folder):
    house = warehouse(spark, folder)
    return lookup(house.stg_orders_stream, house.stg_customers, "customer_id", "customer_id",
                  {"full_name": "full_name"}, spread_by=("event_id",), matched="matched").select(
        "event_id", "customer_id", "matched", "full_name")


@query("join05_inventory_products_suppliers", """
    SELECT event_id, quantity_after, i.product_id, p.supplier_id, supplier_name, s.country AS home
    FROM stg_inventory_updates i LEFT JOIN stg_products p USING (product_id)
         LEFT JOIN stg_suppliers s ON p.supplier_id = s.supplier_id""")
def _(spark, folder):
    house = warehouse(spark, folder)
    catalogue = lookup(house.stg_products, house.stg_suppliers, "supplier_id", "supplier_id",
                       {"supplier_name": "supplier_name", "country": "home"})
    columns = {name: name for name in ("supplier_id", "supplier_name", "home")}
    return lookup(house.stg_inventory_updates, catalogue, "product_id", "product_id", columns).select(
        "event_id", "quantity_after", "product_id", *columns)


@query("join06_orders_left_line_summary", """
    SELECT order_id, coalesce(line_item_count, 0) AS line_item_count, has_discounted_item IS NULL AS without_lines
    FROM stg_orders_history LEFT JOIN order_summary USING (order_id)""")
def _(spark, folder):
    house = warehouse(spark, folder)
    summary = marts.order_line_summary(house.int_order_lines)
    return house.stg_orders_history.join(summary, "order_id", "left").select(
        "order_id", F.coalesce("line_item_count", F.lit(0)).alias("line_item_count"),
        C("has_discounted_item").isNull().alias("without_lines"))


@query("join07_customers_left_orders", """
    SELECT customer_id, coalesce(n, 0) AS total_orders FROM stg_customers
    LEFT JOIN (SELECT customer_id, count(*) AS n FROM stg_orders_history GROUP BY customer_id)
    USING (customer_id)""")
def _(spark, folder):
    """Orders per customer; customers without any are kept."""
    house = warehouse(spark, folder)
    counted = house.stg_orders_history.groupBy("customer_id").agg(F.count("*").alias("total_orders"))
    return house.stg_customers.join(counted, "customer_id", "left").select(
        "customer_id", F.coalesce("total_orders", F.lit(0)).alias("total_orders"))


@query("join08_products_star", """
    SELECT product_id, s.supplier_name, coalesce(total_orders, 0) AS total_orders,
           coalesce(total_inventory_events, 0) AS events
    FROM stg_products LEFT JOIN stg_suppliers s USING (supplier_id) LEFT JOIN sales USING (product_id)
         LEFT JOIN stock USING (product_id)""")
def _(spark, folder):
    return warehouse(spark, folder).mart_products.select(
        "product_id", "supplier_name", "total_orders", C("total_inventory_events").alias("events"))


@query("join09_sessions_left_customers", """
    SELECT session_id, user_id, customer_id IS NOT NULL AS known, full_name
    FROM int_clickstream_sessionized LEFT JOIN stg_customers ON user_id = customer_id""")
def _(spark, folder):
    house = warehouse(spark, folder)
    return lookup(house.int_clickstream_sessionized, house.stg_customers, "user_id", "customer_id",
                  {"full_name": "full_name"}, spread_by=("session_id",), matched="known").select(
        "session_id", "user_id", "known", "full_name")


@query("join10_item_count_per_order", """
    SELECT order_id, order_status, count(order_item_id) AS item_count
    FROM stg_orders_history LEFT JOIN stg_order_items USING (order_id) GROUP BY order_id, order_status""")
def _(spark, folder):
    house = warehouse(spark, folder)
    return feeds.item_counts(house.stg_orders_history, house.stg_order_items).select(
        "order_id", "order_status", "item_count")


@query("join11_known_customer_share", """
    SELECT count(customer_id) AS element_count,
           count(*) FILTER (customer_id IN (SELECT customer_id FROM stg_customers)) AS known_count
    FROM raw_orders_stream""")
def _(spark, folder):
    # which ids exist does not depend on the version kept, so the raw table will do
    return known_key_share(raw(spark, folder, "orders_stream"), "customer_id",
                           raw(spark, folder, "customers"), "customer_id")


@query("join12_files_not_loaded", """
    SELECT DISTINCT kafka_partition AS landed_partition FROM raw_orders_stream WHERE kafka_partition >= 2""")
def _(spark, folder):
    """Files landed in two turns; those of the first one are in the loaded set already."""
    landed, manifest = fresh_folder(spark, "join12-landed"), fresh_folder(spark, "join12")
    events = raw(spark, folder, "orders_stream").withColumn("landed_partition", C("kafka_partition"))
    for low, high in ((0, 1), (2, 3)):
        part = events.where(C("kafka_partition").between(low, high))
        part.write.partitionBy("landed_partition").mode("append").parquet(landed)
        if low == 0:
            state.mark_loaded(list_files(spark, landed), manifest, 0)
    left = state.pending(list_files(spark, landed), state.manifest(spark, manifest))
    return left.select(F.regexp_extract("path", r"landed_partition=(\d+)", 1).cast("int").alias("landed_partition")).distinct()


@query("join13_update_from_aggregate", """
    SELECT order_id, CAST(coalesce(total, total_amount) AS DOUBLE) AS new_total FROM stg_orders_history
    LEFT JOIN (SELECT order_id, round(sum(subtotal), 2) AS total FROM stg_order_items GROUP BY order_id)
    USING (order_id)""")
def _(spark, folder):
    house = warehouse(spark, folder)
    totals = house.stg_order_items.groupBy("order_id").agg(money.total(C("subtotal")).alias("total"))
    widened = house.stg_orders_history.withColumn("total_amount", C("total_amount").cast(money.TOTAL))
    return upsert.update_from(widened, totals, "order_id", "total_amount", "total").select(
        "order_id", C("total_amount").alias("new_total"))


FOREIGN_KEY_SQL = " UNION ALL ".join(
    f"SELECT '{child}.{key}' AS foreign_key, {key} AS orphan_key, count(*) AS child_rows FROM raw_{child} "
    f"WHERE {key} NOT IN (SELECT {schemas.PRIMARY_KEYS[parent]} FROM raw_{parent}) GROUP BY {key}"
    for child, key, parent in schemas.FOREIGN_KEYS
) + """ UNION ALL SELECT 'orders_stream.customer_id', customer_id, count(*) FROM raw_orders_stream
        WHERE customer_id NOT IN (SELECT customer_id FROM raw_customers) GROUP BY customer_id"""


def all_orphans(spark, folder):
    """Orphans of the declared foreign keys, and of the order events' customers."""
    found = None
    for child, key, parent in (*schemas.FOREIGN_KEYS, ("orders_stream", "customer_id", "customers")):
        part = orphans(raw(spark, folder, child), key, raw(spark, folder, parent), schemas.PRIMARY_KEYS[parent])
        part = part.select(F.lit(f"{child}.{key}").alias("foreign_key"), "orphan_key", "child_rows")
        found = part if found is None else found.unionByName(part)
    return found


REGISTER.add("join14_foreign_key_orphans", all_orphans, FOREIGN_KEY_SQL)


# ------------------------------------------------------------------ aggregations
@query("agg01_group_by_key", """
    SELECT order_id, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS units_sold FROM stg_order_items GROUP BY order_id""")
def _(spark, folder):
    return warehouse(spark, folder).stg_order_items.groupBy("order_id").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("units_sold"))


CALENDAR = "order_date_day order_week order_month order_year order_month_num order_day_of_week"


@query("agg02_group_by_calendar", f"""
    SELECT {rendered_sql(CALENDAR)}, n FROM (
        SELECT CAST(order_date AS DATE) AS order_date_day, date_trunc('week', order_date) AS order_week,
               date_trunc('month', order_date) AS order_month, year(order_date) AS order_year,
               month(order_date) AS order_month_num, dayofweek(order_date) + 1 AS order_day_of_week, count(*) AS n
        FROM stg_orders_history GROUP BY ALL)""")
def _(spark, folder):
    orders = warehouse(spark, folder).stg_orders_history.withColumns(temporal.order_calendar(C("order_date")))
    return orders.groupBy(*CALENDAR.split()).agg(F.count("*").alias("n"))


@query("agg03_count_rows", "SELECT session_id, count(*) AS clicks FROM stg_clickstream GROUP BY session_id")
def _(spark, folder):
    return warehouse(spark, folder).stg_clickstream.groupBy("session_id").agg(F.count("*").alias("clicks"))


@query("agg04_count_distinct", """
    SELECT warehouse_id, count(DISTINCT product_id) AS products, count(DISTINCT sku) AS skus,
           count(DISTINCT quantity_after) AS levels FROM stg_inventory_updates GROUP BY warehouse_id""")
def _(spark, folder):
    return aggregates.distinct_counts(warehouse(spark, folder).stg_inventory_updates, "warehouse_id",
                           {"products": "product_id", "skus": "sku", "levels": "quantity_after"})


@query("agg05_conditional_count", """
    SELECT customer_id, count(*) FILTER (order_status = 'DELIVERED') AS delivered,
           count(*) FILTER (order_status = 'CANCELLED') AS cancelled,
           count(*) FILTER (order_status = 'REFUNDED') AS refunded FROM stg_orders_history GROUP BY customer_id""")
def _(spark, folder):
    status = C("order_status")
    return warehouse(spark, folder).stg_orders_history.groupBy("customer_id").agg(*[
        F.count_if(status == name).alias(name.lower()) for name in ("DELIVERED", "CANCELLED", "REFUNDED")])


@query("agg06_conditional_sum", f"""
    SELECT product_id, {units('restock')} AS restocked, {units('depletion')} AS depleted
    FROM stg_inventory_updates GROUP BY product_id""")
def _(spark, folder):
    moved = F.abs("quantity_change")
    return warehouse(spark, folder).stg_inventory_updates.groupBy("product_id").agg(*[
        F.sum(F.when(C("movement_type") == kind, moved).otherwise(0)).alias(alias)
        for kind, alias in (("restock", "restocked"), ("depletion", "depleted"))])


@query("agg07_sum", f"""
    SELECT product_id, CAST(sum(subtotal) AS DOUBLE) AS total, CAST(sum(quantity) AS BIGINT) AS units_sold
    FROM stg_order_items GROUP BY product_id""")
def _(spark, folder):
    return warehouse(spark, folder).stg_order_items.groupBy("product_id").agg(
        money.total(C("subtotal")).alias("total"), F.sum("quantity").alias("units_sold"))


@query("agg08_average", f"""
    SELECT order_status, {mean('sum(total_amount)', 'count(total_amount)')} AS mean_amount,
           {mean('sum(days_to_ship)', 'count(days_to_ship)')} AS mean_days
    FROM stg_orders_history GROUP BY order_status""")
def _(spark, folder):
    return warehouse(spark, folder).stg_orders_history.groupBy("order_status").agg(
        F.avg("total_amount").alias("mean_amount"),
        money.average(F.sum("days_to_ship"), F.count("days_to_ship")).alias("mean_days"))


@query("agg09_min_max", f"""
    SELECT customer_id, {rendered_sql('first_order_date last_order_date')}, CAST(low AS DOUBLE) AS low,
           CAST(high AS DOUBLE) AS high
    FROM (SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
                 min(total_amount) AS low, max(total_amount) AS high FROM stg_orders_history GROUP BY customer_id)""")
def _(spark, folder):
    return warehouse(spark, folder).stg_orders_history.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        F.min("total_amount").alias("low"), F.max("total_amount").alias("high"))


@query("agg10_most_frequent", """
    SELECT session_id, v AS user_id FROM (SELECT DISTINCT session_id FROM stg_clickstream)
    LEFT JOIN most_frequent_user ON session_id = k""",
    {"most_frequent_user": commonest("stg_clickstream", "session_id", "user_id")})
def _(spark, folder):
    clicks = warehouse(spark, folder).stg_clickstream
    return aggregates.most_frequent(clicks, ["session_id"], "user_id", "user_id")


@query("agg11_bool_or", """
    SELECT session_id, bool_or(event_type = 'PURCHASE') AS bought, bool_or(NOT is_anonymous) AS identified
    FROM stg_clickstream GROUP BY session_id""")
def _(spark, folder):
    return warehouse(spark, folder).stg_clickstream.groupBy("session_id").agg(
        F.bool_or(C("event_type") == "PURCHASE").alias("bought"), F.bool_or(~C("is_anonymous")).alias("identified"))


@query("agg12_first_by_time", """
    SELECT session_id, arg_min_null(page_url, (event_timestamp, event_id)) AS entry_page,
           arg_min_null(referrer, (event_timestamp, event_id)) AS referrer FROM stg_clickstream GROUP BY session_id""")
def _(spark, folder):
    moment = (C("event_timestamp"), C("event_id"))
    return warehouse(spark, folder).stg_clickstream.groupBy("session_id").agg(
        aggregates.first_by(C("page_url"), *moment).alias("entry_page"),
        aggregates.first_by(C("referrer"), *moment).alias("referrer"))


@query("agg13_last_by_time", """
    SELECT warehouse_id, product_id,
           arg_max_null(quantity_after, (event_timestamp, event_id, coalesce(quantity_after, -1))) AS level
    FROM stg_inventory_updates GROUP BY warehouse_id, product_id""")
def _(spark, folder):
    order = (C("event_timestamp"), C("event_id"), C("quantity_after"))
    return warehouse(spark, folder).stg_inventory_updates.groupBy("warehouse_id", "product_id").agg(
        aggregates.last_by(C("quantity_after"), *order).alias("level"))


@query("agg14_expression_over_aggregates", """
    SELECT session_id, date_diff('second', min(event_timestamp), max(event_timestamp)) AS duration,
           CASE WHEN bool_or(event_type = 'PURCHASE') THEN 'converted' WHEN count(*) >= 5 THEN 'active'
                ELSE 'other' END AS label FROM stg_clickstream GROUP BY session_id""")
def _(spark, folder):
    bought = F.bool_or(C("event_type") == "PURCHASE")
    duration = temporal.seconds_between(F.min("event_timestamp"), F.max("event_timestamp"))
    return warehouse(spark, folder).stg_clickstream.groupBy("session_id").agg(
        duration.alias("duration"),
        F.when(bought, "converted").when(F.count("*") >= 5, "active").otherwise("other").alias("label"))


@query("agg15_row_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM raw_{name}" for name in schemas.BATCH_TABLES))
def _(spark, folder):
    return aggregates.row_counts({name: raw(spark, folder, name) for name in schemas.BATCH_TABLES})


@query("agg16_reconcile_counts", " UNION ALL ".join(f"""
    SELECT '{name}' AS table_name, s AS source_count, t AS target_count, abs(s - t) / s AS difference_ratio,
           abs(s - t) / s <= 0.01 AS within_tolerance
    FROM (SELECT (SELECT count(*) FROM raw_{name}) AS s, (SELECT count(*) FROM stg_{name}) AS t)"""
    for name in schemas.BATCH_TABLES))
def _(spark, folder):
    house = warehouse(spark, folder)
    return aggregates.reconcile(
        aggregates.row_counts({name: house.raw[name] for name in schemas.BATCH_TABLES}),
        aggregates.row_counts({name: house.model(f"stg_{name}") for name in schemas.BATCH_TABLES}))


@query("agg17_count_child_after_left_join", """
    SELECT order_id, customer_id, order_status, payment_method, CAST(total_amount AS DOUBLE) AS amount,
           shipping_address, count(order_item_id) AS item_count
    FROM stg_orders_history LEFT JOIN stg_order_items USING (order_id) GROUP BY ALL""")
def _(spark, folder):
    house = warehouse(spark, folder)
    return feeds.item_counts(house.stg_orders_history, house.stg_order_items).select(
        "order_id", "customer_id", "order_status", "payment_method", C("total_amount").alias("amount"),
        "shipping_address", "item_count")


@query("agg18_high_water_mark", f"""
    SELECT 'customers' AS table_name, {rendered_sql('last_extracted_at')}, n AS last_row_count
    FROM (SELECT max(created_at) AS last_extracted_at, count(*) AS n FROM raw_customers)""")
def _(spark, folder):
    from datetime import datetime

    mark = state.watermark_of(raw(spark, folder, "customers"), "customers", "created_at", datetime(2001, 8, 2), "")
    return mark.select("table_name", "last_extracted_at", "last_row_count")


# ------------------------------------------------------------------ windows
@query("win01_keep_latest_items", f"""
    SELECT order_item_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS price, {rendered_sql('created_at')}
    FROM ({latest('raw_order_items', 'order_item_id', 'order_id', 'product_id', 'quantity', 'unit_price',
                  'discount', 'subtotal', 'created_at')})""")
def _(spark, folder):
    return keep_latest(raw(spark, folder, "order_items"), "order_item_id").select(
        "order_item_id", "product_id", "quantity", C("unit_price").alias("price"), "created_at")


@query("win02_filter_before_latest", """
    SELECT order_id, strftime(_ingested_at, '%Y-%m-%d') AS loaded FROM stg_orders_history""")
def _(spark, folder):
    """The newest load of some orders cannot be read: their older load survives."""
    staged = staging.stg_orders_history(raw(spark, folder, "orders_history"))
    return staged.select("order_id", F.date_format("_ingested_at", "yyyy-MM-dd").alias("loaded"))


# ------------------------------------------------------------------ order and limit
@query("srt01_ascending_extract", f"""
    SELECT order_id, {rendered_sql('order_date')} FROM stg_orders_history ORDER BY 2, 1""")
def _(spark, folder):
    return warehouse(spark, folder).stg_orders_history.select("order_id", "order_date").orderBy("order_date", "order_id")


@query("srt02_newest_orders", f"""
    SELECT order_id, {rendered_sql('order_date total_amount')} FROM (
        SELECT * FROM stg_orders_history ORDER BY order_date DESC, order_id DESC LIMIT 50)""")
def _(spark, folder):
    orders = warehouse(spark, folder).stg_orders_history
    return ranking.top_n(orders, 50, F.desc("order_date"), F.desc("order_id")).select(
        "order_id", "order_date", "total_amount")


@query("srt03_random_customers", """
    SELECT customer_id, email FROM stg_customers ORDER BY md5('7:' || customer_id), customer_id LIMIT 100""")
def _(spark, folder):
    return ranking.sample_n(warehouse(spark, folder).stg_customers, "customer_id", 100, seed=7).select(
        "customer_id", "email")


@query("srt04_newest_file", """
    SELECT arg_max(_source_file, (_loaded_at, _source_file)) AS _source_file FROM raw_orders_stream""")
def _(spark, folder):
    return ranking.newest(raw(spark, folder, "orders_stream"), "_source_file", "_loaded_at", "_source_file")


@query("srt05_show_first_rows", f"""
    SELECT event_id, event_type, order_status, {rendered_sql('total_amount')}, payment_method
    FROM stg_orders_stream ORDER BY event_id LIMIT 5""")
def _(spark, folder):
    shown = warehouse(spark, folder).stg_orders_stream.select(
        "event_id", "event_type", "order_status", "total_amount", "payment_method")
    return ranking.top_n(shown, 5, C("event_id"))


# ------------------------------------------------------------------ set operations
@query("set01_union_all", """
    SELECT 'order' AS kind, event_id FROM raw_orders_stream UNION ALL SELECT 'click', event_id FROM raw_clickstream
    UNION ALL SELECT 'stock', event_id FROM raw_inventory_updates""")
def _(spark, folder):
    kinds = {"order": "orders_stream", "click": "clickstream", "stock": "inventory_updates"}
    parts = [raw(spark, folder, name).select(F.lit(kind).alias("kind"), "event_id") for kind, name in kinds.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("set02_union_by_name", """
    SELECT event_id, kafka_partition, user_id, NULL AS sku, source FROM raw_clickstream UNION ALL
    SELECT event_id, kafka_partition, NULL, sku, source FROM raw_inventory_updates""")
def _(spark, folder):
    clicks = raw(spark, folder, "clickstream").select("event_id", "kafka_partition", "user_id", "source")
    stock = raw(spark, folder, "inventory_updates").select("source", "sku", "kafka_partition", "event_id")
    return clicks.unionByName(stock, allowMissingColumns=True)


@query("set03_key_set_difference", """
    SELECT customer_id FROM raw_orders_stream EXCEPT SELECT customer_id FROM raw_customers""")
def _(spark, folder):
    seen = raw(spark, folder, "orders_stream").select("customer_id").distinct()
    return seen.join(raw(spark, folder, "customers").select("customer_id"), "customer_id", "left_anti")


@query("set03b_key_set_union", """
    SELECT _source_file AS path FROM raw_orders_stream UNION SELECT _source_file FROM raw_clickstream""")
def _(spark, folder):
    files = [raw(spark, folder, name).select(C("_source_file").alias("path")) for name in ("orders_stream", "clickstream")]
    return state.extended(*files)


# ------------------------------------------------------------------ recent orders feed
RECENT = """
    SELECT order_id, customer_id, order_status, payment_method, CAST(total_amount AS DOUBLE) AS total_amount,
           (SELECT count(*) FROM stg_order_items i WHERE i.order_id = o.order_id) AS item_count,
           CASE WHEN len(parts) > 1 THEN substr(trim(parts[2]), 1, 50) ELSE 'Unknown' END AS shipping_city,
           CASE WHEN len(parts) > 2 THEN substr(trim(parts[-1]), 1, 50) ELSE 'US' END AS shipping_country
    FROM (SELECT *, string_split(coalesce(shipping_address, ''), ',') AS parts FROM stg_orders_history
          ORDER BY order_date DESC, order_id DESC LIMIT 100) o"""


@query("mdl12_recent_orders_feed", """
    SELECT *, to_json({'order_id': order_id, 'customer_id': customer_id, 'order_status': order_status,
                       'payment_method': payment_method, 'total_amount': total_amount, 'item_count': item_count,
                       'shipping_city': shipping_city, 'shipping_country': shipping_country}) AS payload
    FROM recent""", {"recent": RECENT})
def _(spark, folder):
    house = warehouse(spark, folder)
    return feeds.recent_orders(house.stg_orders_history, house.stg_order_items, 100)
