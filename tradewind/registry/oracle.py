"""The entities and models once more, as DuckDB common table expressions.

They are written against the same test tables, independently of the Spark plans: distinct counts
and most frequent values are computed directly, averages by exact integer arithmetic.
"""

from __future__ import annotations

import re

from tradewind.registry.contract import MODEL_COLUMNS, rendered_sql


def mean(total: str, count: str, digits: int = 6) -> str:
    """total / count, half away from zero, exact for totals with at most ``digits`` decimals."""
    scaled = f"CAST(({total}) * {10 ** digits} AS HUGEINT)"
    return f"CASE WHEN ({count}) > 0 THEN (2 * {scaled} + ({count})) // (2 * ({count})) / 1e{digits} END"


def commonest(table: str, key: str, value: str, where: str = "TRUE") -> str:
    """Most frequent value per key, the smallest on a tie."""
    return f"""
        SELECT k, v FROM (
            SELECT {key} AS k, {value} AS v,
                   row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {value}) AS place
            FROM {table} WHERE {value} IS NOT NULL AND {where} GROUP BY {key}, {value}
        ) WHERE place = 1"""


def latest(table: str, key: str, *ties: str, where: str = "TRUE") -> str:
    order = ", ".join(f"{name} DESC NULLS LAST" for name in ("_ingested_at", *ties))
    return f"""SELECT * FROM {table} WHERE {key} IS NOT NULL AND {where}
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


TIER = "CASE WHEN total_amount >= 300000 THEN 'high' WHEN total_amount >= 100000 THEN 'medium' ELSE 'low' END"
HEALTH = ("CASE WHEN {0} = 0 THEN 'out_of_stock' WHEN {0} <= 10 THEN 'critical' "
          "WHEN {0} <= 50 THEN 'low' ELSE 'healthy' END")
AS_OF = "TIMESTAMP '2001-08-02'"
ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
ISO_MICROS = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"


def units(kind: str) -> str:
    return f"CAST(sum(CASE WHEN movement_type = '{kind}' THEN abs(quantity_change) ELSE 0 END) AS BIGINT)"


TABLES: dict[str, str] = {}

# ---------------------------------------------------------------- raw entities
TABLES["raw_customers"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
           '  ' || split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) || ' ' AS last_name,
           CASE WHEN load = 1 THEN 'New.' ELSE '' END || replace(c_name, '#', '.') || '@Example.com ' AS email,
           '+' || c_nationkey || '-' || c_custkey AS phone,
           c_custkey || ' ' || c_mktsegment || ' street, ' || n_name || ', ' || r_name AS address,
           n_name AS city, ' ' || c_mktsegment AS state, r_name AS country,
           lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
           TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 365 AS INT)) AS created_at,
           TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 365 + load AS INT)) AS updated_at,
           TIMESTAMP '2001-07-01' + to_days(load) AS _ingested_at
    FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    JOIN (VALUES (0), (1)) loads(load) ON load = 0 OR c_custkey % 7 = 0"""

TABLES["raw_suppliers"] = """
    SELECT CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name || ' ' AS supplier_name,
           CASE WHEN s_suppkey % 3 <> 0 THEN 'Contact ' || s_suppkey END AS contact_name,
           replace(s_name, '#', '.') || CASE WHEN load = 1 THEN '.new' ELSE '' END || '@Example.com' AS email,
           '+' || s_nationkey AS phone, s_suppkey || ' dock road' AS address,
           n_name AS city, ' ' || n_name || ' ' AS country,
           TIMESTAMP '1993-01-01' + to_days(CAST(s_suppkey % 365 AS INT)) AS created_at,
           TIMESTAMP '2001-07-01' + to_days(load) AS _ingested_at
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    JOIN (VALUES (0), (1)) loads(load) ON load = 0 OR s_suppkey % 5 = 0"""

TABLES["raw_products"] = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(s_key AS VARCHAR) AS supplier_id,
           ' ' || p_name AS product_name, p_type || ' ' AS category, p_brand AS subcategory,
           CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, CAST(p_size + load AS INT) AS stock_quantity,
           p_brand || '-' || p_partkey AS sku, p_size > 2 AS is_active,
           TIMESTAMP '1993-06-01' + to_days(CAST(p_partkey % 365 AS INT)) AS created_at,
           TIMESTAMP '1993-06-01' + to_days(CAST(p_partkey % 365 + load AS INT)) AS updated_at,
           TIMESTAMP '2001-07-01' + to_days(load) AS _ingested_at
    FROM part
    LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS s_key FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey
    JOIN (VALUES (0), (1)) loads(load) ON load = 0 OR p_partkey % 9 = 0"""

TABLES["raw_orders_history"] = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           ' ' || status AS order_status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
           ['credit_card', 'debit_card', 'paypal', 'bank_transfer', 'crypto'][o_orderkey % 5 + 1] AS payment_method,
           CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_orderkey || ' Main St'
                WHEN 2 THEN o_orderkey || ' Main St, City' || o_orderkey % 10
                ELSE o_orderkey || ' Main St, City' || o_orderkey % 10 || ', Country' END AS shipping_address,
           CASE WHEN load = 1 AND o_orderkey % 33 = 0 THEN 'not-a-date'
                ELSE strftime(o_orderdate, {ISO}) END AS order_date,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN strftime(ship_time, {ISO}) END AS shipped_date,
           CASE WHEN status = 'delivered'
                THEN strftime(ship_time + to_days(CAST(1 + o_orderkey % 5 AS INT)), {ISO}) END AS delivered_date,
           strftime(o_orderdate, {ISO}) AS created_at,
           TIMESTAMP '2001-07-01' + to_days(load) AS _ingested_at
    FROM (SELECT *, o_orderdate + to_days(CAST(1 + o_orderkey % 7 AS INT)) AS ship_time,
                 CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'cancelled'
                      WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'refunded'
                      WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                      ELSE 'processing' END AS status
          FROM orders)
    JOIN (VALUES (0), (1)) loads(load) ON load = 0 OR o_orderkey % 11 = 0"""

TABLES["raw_order_items"] = """
    SELECT *, CAST(round(quantity * unit_price * (1 - coalesce(discount, 0)), 2) AS DECIMAL(12,2)) AS subtotal
    FROM (
        SELECT l_orderkey || '-' || l_linenumber AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INT) AS quantity,
               CAST(CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) + CAST(l_quantity AS BIGINT))
                    // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(12,2)) AS unit_price,
               CASE WHEN l_discount <> 0 THEN CAST(l_discount AS DECIMAL(12,4)) END AS discount,
               l_shipdate AS created_at, l_shipdate AS _ingested_at
        FROM lineitem)"""

TABLES["raw_orders_stream"] = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS kafka_key, o_orderkey // 4 AS kafka_offset,
           CAST(o_orderkey % 4 AS INT) AS kafka_partition,
           TIMESTAMP '2001-08-01' + to_seconds(o_orderkey * 7 % 86400) AS kafka_timestamp,
           'os-' || o_orderkey AS event_id,
           ['order_created', ' Order_Updated', 'order_cancelled'][o_orderkey % 3 + 1] AS event_type,
           CASE WHEN o_orderkey % 97 = 0 THEN 'bad'
                ELSE strftime(o_orderdate + to_seconds(o_orderkey % 3600), {ISO_MICROS}) END AS event_timestamp,
           CAST(o_orderkey AS VARCHAR) AS order_id,
           CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE '' END || o_custkey AS customer_id,
           ['pending', 'confirmed', 'shipped ', 'delivered', 'Processing'][o_orderkey % 5 + 1] AS order_status,
           ['paypal', 'crypto', 'credit_card'][o_orderkey % 3 + 1] AS payment_method,
           o_totalprice AS total_amount, CAST(1 + o_orderkey % 7 AS INT) AS item_count,
           'City' || o_orderkey % 10 || ' ' AS shipping_city,
           CASE WHEN o_orderkey % 2 = 0 THEN 'US' ELSE 'DE' END AS shipping_country,
           'postgres_cdc' AS source, o_orderdate + to_days(1) AS ingested_at, o_orderdate + to_days(2) AS _loaded_at,
           'part-' || o_orderkey % 8 || '.parquet' AS _source_file
    FROM orders"""

TABLES["raw_clickstream"] = f"""
    SELECT CAST(event_id AS VARCHAR) AS kafka_key, event_id // 4 AS kafka_offset,
           CAST(event_id % 4 AS INT) AS kafka_partition,
           TIMESTAMP '2024-01-31' + to_seconds(event_id * 7 % 86400) AS kafka_timestamp,
           'ce-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, click || ' ' AS event_type,
           CASE WHEN event_id % 89 = 0 THEN 'yesterday' ELSE strftime(ts, {ISO_MICROS}) END AS event_timestamp,
           user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
           CASE WHEN event_id % 10 < 3 THEN NULL WHEN event_id % 50 = 7 THEN 'Guest '
                ELSE CAST(user_id AS VARCHAR) END AS user_id,
           CASE click WHEN 'product_view' THEN '/products/' || event_id % 200 WHEN 'add_to_cart' THEN '/cart'
                WHEN 'checkout' THEN CASE WHEN event_id % 2 = 0 THEN '/checkout' ELSE '/checkout/payment' END
                WHEN 'purchase' THEN '/checkout/confirmation' ELSE '/page/' || event_id % 5 END AS page_url,
           CASE WHEN click IN ('product_view', 'add_to_cart', 'purchase')
                THEN CAST(event_id % 200 AS VARCHAR) END AS product_id,
           CASE WHEN event_id % 6 <> 0 THEN ' Category ' || event_id % 10 END AS category,
           ['Desktop', ' mobile', 'tablet'][event_id % 3 + 1] AS device_type,
           ['Chrome', 'Safari', 'Firefox', 'Edge', 'Samsung Internet'][event_id % 5 + 1] AS browser,
           CASE WHEN event_id % 8 < 5 THEN 'https://ref' || event_id % 5 || '.example' END AS referrer,
           CAST(CAST(value AS DECIMAL(12,2)) * 1000 AS BIGINT) + event_id % 10 AS time_on_page_ms,
           'web_frontend' AS source, ts + to_hours(1) AS ingested_at, ts + to_hours(2) AS _loaded_at,
           'part-' || event_id % 8 || '.parquet' AS _source_file
    FROM (SELECT *, CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
                         WHEN 'signup' THEN 'checkout' WHEN 'purchase' THEN 'purchase'
                         WHEN 'error' THEN 'page_view' END AS click FROM events)"""

TABLES["raw_inventory_updates"] = f"""
    SELECT CAST(l_partkey AS VARCHAR) AS kafka_key, l_orderkey AS kafka_offset,
           CAST(l_partkey % 4 AS INT) AS kafka_partition,
           TIMESTAMP '2001-11-05' + to_seconds((l_orderkey + l_linenumber) * 7 % 86400) AS kafka_timestamp,
           concat_ws('-', 'inv', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
           CASE l_returnflag WHEN 'R' THEN 'restock' WHEN 'A' THEN 'Sale_deduction' ELSE 'adjustment' END AS event_type,
           strftime(l_shipdate, {ISO_MICROS}) AS event_timestamp,
           CAST(l_partkey AS VARCHAR) AS product_id, 'SKU-' || l_partkey || ' ' AS sku,
           ['WH-EAST-01', 'WH-WEST-01', 'WH-CENTRAL-01', 'WH-SOUTH-01'][l_suppkey % 4 + 1] AS warehouse_id,
           CAST(l_orderkey % 60 AS INT) AS quantity_before, moved AS quantity_change,
           CASE WHEN l_orderkey % 50 <> 49
                THEN CAST(greatest(0, l_orderkey % 60 + moved) AS INT) END AS quantity_after,
           CASE l_returnflag WHEN 'R' THEN 'supplier_delivery' WHEN 'A' THEN 'order_fulfilled'
                ELSE 'inventory_audit' END AS reason,
           CASE l_returnflag WHEN 'R' THEN 'system' WHEN 'A' THEN 'order_fulfillment' ELSE 'manual' END AS triggered_by,
           'inventory_service' AS source, l_shipdate + to_hours(1) AS ingested_at, l_shipdate + to_hours(2) AS _loaded_at,
           'part-' || l_partkey % 8 || '.parquet' AS _source_file
    FROM (SELECT *, CASE l_returnflag WHEN 'R' THEN CAST(l_quantity AS INT)
                         WHEN 'A' THEN -CAST(l_quantity AS INT) ELSE 0 END AS moved FROM lineitem)"""

# ---------------------------------------------------------------- staging
TABLES["stg_customers"] = f"""
    SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
           coalesce(trim(first_name), '') || ' ' || coalesce(trim(last_name), '') AS full_name,
           lower(trim(email)) AS email, trim(phone) AS phone, trim(address) AS address, trim(city) AS city,
           trim(state) AS state, trim(country) AS country, trim(postal_code) AS postal_code,
           created_at, updated_at, _ingested_at
    FROM ({latest('raw_customers', 'customer_id')})"""
TABLES["stg_products"] = f"""
    SELECT product_id, supplier_id, trim(product_name) AS product_name, trim(category) AS category,
           trim(subcategory) AS subcategory, trim(sku) AS sku, unit_price, stock_quantity, is_active,
           created_at, updated_at, _ingested_at
    FROM ({latest('raw_products', 'product_id')})"""
TABLES["stg_suppliers"] = f"""
    SELECT supplier_id, trim(supplier_name) AS supplier_name, trim(contact_name) AS contact_name,
           lower(trim(email)) AS email, trim(phone) AS phone, trim(address) AS address, trim(city) AS city,
           trim(country) AS country, created_at, _ingested_at
    FROM ({latest('raw_suppliers', 'supplier_id')})"""
TABLES["stg_orders_history"] = f"""
    SELECT *, date_diff('day', order_date, shipped_date) AS days_to_ship
    FROM (SELECT order_id, customer_id, upper(trim(order_status)) AS order_status,
                 upper(trim(payment_method)) AS payment_method, trim(shipping_address) AS shipping_address,
                 total_amount, TRY_CAST(order_date AS TIMESTAMP) AS order_date,
                 TRY_CAST(shipped_date AS TIMESTAMP) AS shipped_date,
                 TRY_CAST(delivered_date AS TIMESTAMP) AS delivered_date,
                 TRY_CAST(created_at AS TIMESTAMP) AS created_at, _ingested_at
          FROM ({latest('raw_orders_history', 'order_id',
                        where="TRY_CAST(order_date AS TIMESTAMP) IS NOT NULL "
                              "AND TRY_CAST(created_at AS TIMESTAMP) IS NOT NULL")}))"""
TABLES["stg_order_items"] = f"""
    SELECT order_item_id, order_id, product_id, quantity, unit_price,
           coalesce(discount, CAST(0 AS DECIMAL(12,4))) AS discount, subtotal,
           CAST(round(CAST(unit_price AS DECIMAL(12,4)) * (1 - coalesce(discount, CAST(0 AS DECIMAL(12,4)))), 2)
                AS DECIMAL(18,2)) AS effective_unit_price, created_at, _ingested_at
    FROM ({latest('raw_order_items', 'order_item_id', 'order_id', 'product_id', 'quantity', 'unit_price',
                  'discount', 'subtotal', 'created_at')})"""
TABLES["stg_orders_stream"] = """
    SELECT event_id, upper(trim(event_type)) AS event_type, TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
           order_id, customer_id, upper(trim(order_status)) AS order_status,
           upper(trim(payment_method)) AS payment_method, CAST(total_amount AS DECIMAL(12,2)) AS total_amount,
           item_count, trim(shipping_city) AS shipping_city, trim(shipping_country) AS shipping_country,
           kafka_offset, kafka_partition, kafka_timestamp, source AS event_source, ingested_at, _loaded_at, _source_file
    FROM raw_orders_stream
    WHERE event_id IS NOT NULL AND TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL"""
TABLES["stg_clickstream"] = """
    SELECT event_id, session_id, upper(trim(event_type)) AS event_type,
           TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, user_id,
           user_id IS NULL OR lower(trim(user_id)) IN ('null', 'guest', '') AS is_anonymous,
           trim(page_url) AS page_url, product_id, trim(category) AS category,
           lower(trim(device_type)) AS device_type, lower(trim(browser)) AS browser, trim(referrer) AS referrer,
           CAST(time_on_page_ms AS INT) AS time_on_page_ms,
           CAST(CAST((time_on_page_ms + 5) // 10 AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))
               AS time_on_page_sec,
           kafka_offset, kafka_partition, kafka_timestamp, source AS event_source, ingested_at, _loaded_at, _source_file
    FROM raw_clickstream
    WHERE event_id IS NOT NULL AND TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL"""
TABLES["stg_inventory_updates"] = """
    SELECT event_id, upper(trim(event_type)) AS event_type, TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
           product_id, trim(sku) AS sku, trim(warehouse_id) AS warehouse_id,
           quantity_before, quantity_change, quantity_after,
           CASE sign(quantity_change) WHEN 1 THEN 'restock' WHEN -1 THEN 'depletion' ELSE 'adjustment' END
               AS movement_type,
           trim(reason) AS reason, trim(triggered_by) AS triggered_by,
           kafka_offset, kafka_partition, kafka_timestamp, source AS event_source, ingested_at, _loaded_at, _source_file
    FROM raw_inventory_updates
    WHERE event_id IS NOT NULL AND TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL"""

# ---------------------------------------------------------------- intermediate
TABLES["int_order_lines"] = """
    SELECT oi.* EXCLUDE (unit_price, created_at, _ingested_at), o.customer_id, o.order_status, o.payment_method,
           o.order_date, o.shipped_date, o.delivered_date, o.days_to_ship, p.product_name, p.category, p.subcategory,
           p.sku, p.supplier_id, p.is_active AS product_is_active, oi.unit_price AS listed_unit_price,
           CAST(oi.effective_unit_price * oi.quantity AS DECIMAL(18,2)) AS line_revenue,
           CAST((oi.unit_price - oi.effective_unit_price) * oi.quantity AS DECIMAL(18,2)) AS discount_amount,
           oi.discount > 0 AS is_discounted, o.order_status = 'DELIVERED' AS is_delivered,
           o.order_status = 'CANCELLED' AS is_cancelled, o.order_status = 'REFUNDED' AS is_refunded,
           oi.created_at AS item_created_at, oi._ingested_at
    FROM stg_order_items oi JOIN stg_orders_history o USING (order_id) LEFT JOIN stg_products p USING (product_id)"""
TABLES["int_orders_with_customers"] = f"""
    SELECT o.* EXCLUDE (created_at), c.full_name AS customer_full_name, c.email AS customer_email,
           c.city AS customer_city, c.state AS customer_state, c.country AS customer_country,
           c.created_at AS customer_since, date_diff('day', c.created_at, o.order_date) AS customer_tenure_days_at_order,
           order_status = 'DELIVERED' AS is_delivered, order_status = 'CANCELLED' AS is_cancelled,
           order_status = 'REFUNDED' AS is_refunded, {TIER} AS order_value_tier, o.created_at AS order_created_at
    FROM stg_orders_history o LEFT JOIN stg_customers c USING (customer_id)"""
TABLES["int_streaming_orders_enriched"] = f"""
    SELECT e.*, c.full_name AS customer_full_name, c.email AS customer_email, c.city AS customer_city,
           c.state AS customer_state, c.country AS customer_country,
           c.customer_id IS NOT NULL AS customer_matched, {TIER} AS order_value_tier
    FROM stg_orders_stream e LEFT JOIN stg_customers c ON e.customer_id = c.customer_id"""
TABLES["session_user"] = commonest("stg_clickstream", "session_id", "user_id")
TABLES["session_facts"] = f"""
    SELECT session_id, bool_or(NOT is_anonymous) AS has_authenticated_event,
           arg_min_null(device_type, (event_timestamp, event_id)) AS device_type,
           arg_min_null(browser, (event_timestamp, event_id)) AS browser,
           min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
           date_diff('second', min(event_timestamp), max(event_timestamp)) AS session_duration_sec,
           count(*) AS total_events, count(DISTINCT page_url) AS unique_pages_viewed,
           count(DISTINCT product_id) AS unique_products_viewed, count(DISTINCT category) AS unique_categories_viewed,
           sum(time_on_page_sec) AS total_time_on_site_sec,
           {mean('sum(time_on_page_sec)', 'count(time_on_page_sec)')} AS avg_time_per_page_sec,
           arg_min_null(page_url, (event_timestamp, event_id)) AS entry_page,
           arg_max_null(page_url, (event_timestamp, event_id)) AS exit_page,
           arg_min_null(referrer, (event_timestamp, event_id)) AS referrer,
           bool_or(event_type = 'PAGE_VIEW') AS has_page_view, bool_or(event_type = 'PRODUCT_VIEW') AS has_product_view,
           bool_or(event_type = 'ADD_TO_CART') AS has_add_to_cart, bool_or(event_type = 'CHECKOUT') AS has_checkout,
           bool_or(event_type = 'PURCHASE') AS has_purchase
    FROM stg_clickstream GROUP BY session_id"""
TABLES["int_clickstream_sessionized"] = """
    SELECT f.*, u.v AS user_id,
           CASE WHEN has_purchase THEN 'purchase' WHEN has_checkout THEN 'checkout'
                WHEN has_add_to_cart THEN 'add_to_cart' WHEN has_product_view THEN 'product_view'
                ELSE 'browse_only' END AS funnel_stage,
           CASE WHEN has_purchase THEN 'converted' WHEN has_add_to_cart THEN 'engaged'
                WHEN total_events >= 5 THEN 'active' ELSE 'bounce' END AS session_quality
    FROM session_facts f LEFT JOIN session_user u ON f.session_id = u.k"""
TABLES["int_inventory_enriched"] = f"""
    SELECT i.*, p.product_name, p.category, p.subcategory, p.unit_price, p.is_active AS product_is_active,
           p.supplier_id, s.supplier_name, s.country AS supplier_country,
           CAST(p.unit_price * abs(quantity_change) AS DECIMAL(18,2)) AS movement_value,
           {HEALTH.format('quantity_after')} AS stock_health,
           coalesce(abs(quantity_change) > 40, FALSE) AS is_large_movement
    FROM stg_inventory_updates i LEFT JOIN stg_products p USING (product_id) LEFT JOIN stg_suppliers s USING (supplier_id)"""

# ---------------------------------------------------------------- marts
TABLES["order_category"] = commonest("int_order_lines", "order_id", "category")
TABLES["order_summary"] = f"""
    SELECT order_id, count(*) AS line_item_count, CAST(sum(quantity) AS BIGINT) AS total_units,
           sum(line_revenue) AS total_line_revenue, sum(discount_amount) AS total_discount_amount,
           {mean('sum(discount)', 'count(discount)', 8)} AS avg_discount_rate,
           count(DISTINCT product_id) AS distinct_products, count(DISTINCT category) AS distinct_categories,
           bool_or(is_discounted) AS has_discounted_item
    FROM int_order_lines GROUP BY order_id"""
TABLES["mart_orders"] = """
    SELECT o.*, coalesce(total_line_revenue, 0) AS total_line_revenue,
           coalesce(total_discount_amount, 0) AS total_discount_amount,
           coalesce(avg_discount_rate, 0) AS avg_discount_rate, coalesce(line_item_count, 0) AS line_item_count,
           coalesce(total_units, 0) AS total_units, coalesce(distinct_products, 0) AS distinct_products,
           coalesce(distinct_categories, 0) AS distinct_categories, has_discounted_item, k.v AS primary_category,
           CAST(order_date AS DATE) AS order_date_day, date_trunc('week', order_date) AS order_week,
           date_trunc('month', order_date) AS order_month, year(order_date) AS order_year,
           month(order_date) AS order_month_num, dayofweek(order_date) + 1 AS order_day_of_week
    FROM int_orders_with_customers o LEFT JOIN order_summary l USING (order_id) LEFT JOIN order_category k
         ON o.order_id = k.k"""
for _name, _value in {"payment": "payment_method", "category": "primary_category", "tier": "order_value_tier"}.items():
    TABLES[f"customer_{_name}"] = commonest("mart_orders", "customer_id", _value)
TABLES["customer_summary"] = f"""
    SELECT customer_id, count(*) AS total_orders, count(*) FILTER (is_delivered) AS delivered_orders,
           count(*) FILTER (is_cancelled) AS cancelled_orders, count(*) FILTER (is_refunded) AS refunded_orders,
           sum(total_amount) AS lifetime_value, {mean('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
           max(total_amount) AS max_order_value, sum(total_discount_amount) AS total_discounts_received,
           min(order_date) AS first_order_date, max(order_date) AS last_order_date
    FROM mart_orders GROUP BY customer_id"""
TABLES["mart_customers"] = f"""
    SELECT c.customer_id, full_name, email, phone, city, state, country, postal_code, created_at AS customer_since,
           coalesce(total_orders, 0) AS total_orders, coalesce(delivered_orders, 0) AS delivered_orders,
           coalesce(cancelled_orders, 0) AS cancelled_orders, coalesce(refunded_orders, 0) AS refunded_orders,
           coalesce(lifetime_value, 0) AS lifetime_value, coalesce(avg_order_value, 0) AS avg_order_value,
           coalesce(max_order_value, 0) AS max_order_value,
           coalesce(total_discounts_received, 0) AS total_discounts_received, first_order_date, last_order_date,
           date_diff('day', first_order_date, last_order_date) AS days_between_first_last_order,
           p.v AS preferred_payment_method, g.v AS preferred_category, t.v AS typical_order_tier,
           date_diff('day', last_order_date, {AS_OF}) AS days_since_last_order,
           CASE WHEN lifetime_value >= 4000000 THEN 'platinum' WHEN lifetime_value >= 2000000 THEN 'gold'
                WHEN lifetime_value >= 1000000 THEN 'silver' WHEN total_orders > 0 THEN 'bronze'
                ELSE 'prospect' END AS customer_segment,
           coalesce(date_diff('day', last_order_date, {AS_OF}) <= 90, FALSE) AS is_active_customer,
           {mean('delivered_orders', 'total_orders', 4)} AS delivery_rate,
           {mean('cancelled_orders', 'total_orders', 4)} AS cancellation_rate, c._ingested_at
    FROM stg_customers c LEFT JOIN customer_summary s USING (customer_id) LEFT JOIN customer_payment p
         ON c.customer_id = p.k LEFT JOIN customer_category g ON c.customer_id = g.k
         LEFT JOIN customer_tier t ON c.customer_id = t.k"""
TABLES["sales"] = f"""
    SELECT product_id, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
           sum(line_revenue) AS total_revenue, {mean('sum(line_revenue)', 'count(line_revenue)')} AS avg_revenue_per_order,
           sum(discount_amount) AS total_discount_given, {mean('sum(discount)', 'count(discount)', 8)} AS avg_discount_rate,
           count(DISTINCT customer_id) AS unique_customers, min(order_date) AS first_sale_date,
           max(order_date) AS last_sale_date
    FROM int_order_lines WHERE NOT (is_cancelled OR is_refunded) GROUP BY product_id"""
TABLES["stock"] = f"""
    SELECT product_id,
           arg_max_null(quantity_after, (event_timestamp, event_id, coalesce(quantity_after, -1))) AS level,
           arg_max_null(stock_health, (event_timestamp, event_id, coalesce(quantity_after, -1))) AS health,
           count(*) AS total_inventory_events, {units('restock')} AS total_units_restocked,
           {units('depletion')} AS total_units_depleted,
           max(event_timestamp) AS last_inventory_update
    FROM int_inventory_enriched GROUP BY product_id"""
TABLES["mart_products"] = f"""
    SELECT p.*, s.supplier_name, s.country AS supplier_country,
           coalesce(total_orders, 0) AS total_orders, coalesce(total_units_sold, 0) AS total_units_sold,
           coalesce(total_revenue, 0) AS total_revenue, coalesce(avg_revenue_per_order, 0) AS avg_revenue_per_order,
           coalesce(total_discount_given, 0) AS total_discount_given,
           coalesce(avg_discount_rate, 0) AS avg_discount_rate, coalesce(unique_customers, 0) AS unique_customers,
           first_sale_date, last_sale_date, coalesce(level, stock_quantity) AS current_stock,
           coalesce(health, {HEALTH.format('stock_quantity')}) AS current_stock_health,
           coalesce(total_inventory_events, 0) AS total_inventory_events,
           coalesce(total_units_restocked, 0) AS total_units_restocked,
           coalesce(total_units_depleted, 0) AS total_units_depleted, last_inventory_update,
           coalesce({mean('total_revenue', 'total_units_sold', 2)}, 0) AS revenue_per_unit_sold,
           CASE WHEN total_revenue >= 1500000 THEN 'top_performer' WHEN total_revenue >= 1000000 THEN 'strong'
                WHEN total_revenue >= 500000 THEN 'moderate' WHEN total_revenue > 0 THEN 'low_performer'
                ELSE 'no_sales' END AS performance_tier
    FROM stg_products p LEFT JOIN stg_suppliers s USING (supplier_id) LEFT JOIN sales USING (product_id)
         LEFT JOIN stock USING (product_id)"""
TABLES["kept_orders"] = "SELECT * FROM mart_orders WHERE NOT (is_cancelled OR is_refunded)"
TABLES["day_country"] = commonest("kept_orders", "order_date_day", "customer_country")
TABLES["mart_revenue_daily"] = f"""
    SELECT d.*, y.v AS top_customer_country
    FROM (SELECT order_date_day AS date_day, order_week, order_month, order_year, order_month_num, order_day_of_week,
                 count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
                 CAST(sum(total_units) AS BIGINT) AS total_units_sold, sum(total_amount) AS gross_revenue,
                 sum(total_line_revenue) AS net_revenue, sum(total_discount_amount) AS total_discounts,
                 {mean('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
                 count(*) FILTER (order_value_tier = 'high') AS high_value_orders,
                 count(*) FILTER (order_value_tier = 'medium') AS medium_value_orders,
                 count(*) FILTER (order_value_tier = 'low') AS low_value_orders,
                 count(*) FILTER (payment_method = 'CREDIT_CARD') AS credit_card_orders,
                 count(*) FILTER (payment_method = 'DEBIT_CARD') AS debit_card_orders,
                 count(*) FILTER (payment_method = 'PAYPAL') AS paypal_orders,
                 count(*) FILTER (payment_method = 'BANK_TRANSFER') AS bank_transfer_orders,
                 count(*) FILTER (is_delivered) AS delivered_orders,
                 {mean('sum(days_to_ship)', 'count(days_to_ship)')} AS avg_days_to_ship
          FROM kept_orders GROUP BY ALL) d
    LEFT JOIN day_country y ON d.date_day = y.k"""
TABLES["mart_funnel"] = """
    SELECT s.*, c.full_name AS customer_full_name, c.email AS customer_email, c.country AS customer_country,
           c.customer_id IS NOT NULL AS is_known_customer, CAST(session_start AS DATE) AS session_date,
           date_trunc('week', session_start) AS session_week, date_trunc('month', session_start) AS session_month,
           hour(session_start) AS session_hour,
           list_position(['browse_only', 'product_view', 'add_to_cart', 'checkout', 'purchase'], funnel_stage)
               AS funnel_stage_num,
           funnel_stage = 'purchase' AS converted, has_add_to_cart AND NOT has_purchase AS cart_abandoned,
           has_checkout AND NOT has_purchase AS checkout_abandoned
    FROM int_clickstream_sessionized s LEFT JOIN stg_customers c ON s.user_id = c.customer_id"""


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with every table expression it needs in front of it."""
    known = {**TABLES, **(extra or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(known[name])

    visit(body)
    heads = [f"{name} AS ({known[name]})" for name in known if name in needed]
    return (f"WITH {', '.join(heads)} " if heads else "") + body


def variant(target: str, suffix: str, cut: dict[str, str], texts: dict[str, str]) -> dict[str, str]:
    """``target`` and the tables between it and those of ``cut`` under names with a suffix. Tables of ``cut`` are
    replaced by their query, and ``texts`` in all others."""
    def leads(name: str) -> bool:
        return name in cut or any(leads(other) for other in TABLES if other != name and re.search(rf"\b{other}\b", TABLES[name]))

    def reached(name: str, seen: set[str]) -> set[str]:
        if name not in seen and leads(name):
            seen.add(name)
            if name not in cut:
                for other in TABLES:
                    if re.search(rf"\b{other}\b", TABLES[name]):
                        reached(other, seen)
        return seen

    names = reached(target, set())

    def renamed(text: str) -> str:
        for old, new in texts.items():
            text = text.replace(old, new)
        return re.sub(rf"\b({'|'.join(sorted(names))})\b", rf"\1_{suffix}", text)

    return {f"{name}_{suffix}": cut[name] if name in cut else renamed(TABLES[name]) for name in TABLES if name in names}


def model_sql(name: str) -> str:
    return f"SELECT {rendered_sql(MODEL_COLUMNS[name])} FROM {name}"
