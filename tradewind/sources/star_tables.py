"""Raw entities derived from the star-schema test tables (customer, orders, lineitem, events, ...).

Each entity is a projection of whole tables with the irregularities staging has to cope with:
repeated loads of a key, padded and mixed-case text, unreadable times, missing keys and values.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.plans.warehouse import Rules, Warehouse
from tradewind.session import configure

AS_OF = datetime(2001, 8, 2)

# Floors that give populated classes on these tables.
RULES = Rules(
    as_of=AS_OF,
    tier_floors=(300_000, 100_000),
    segment_floors=(4_000_000, 2_000_000, 1_000_000),
    performance_floors=(1_500_000, 1_000_000, 500_000),
    large_movement=40,
)

EVENT_TYPES = {
    # event type in the tables -> click type
    "view": "product_view",
    "click": "add_to_cart",
    "signup": "checkout",
    "purchase": "purchase",
    "error": "page_view",
}
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{table}.parquet")


def _loads(second: str) -> Column:
    """Number the loads of a row: 0, and 1 as well where the condition holds."""
    return F.explode(F.when(F.expr(second), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def _arrival(day: str, number: str) -> str:
    """Time at the broker: all events of a topic reach it within one day."""
    return f"timestamp'{day}' + make_dt_interval(0, 0, 0, cast({number} * 7 % 86400 as decimal(18,6)))"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    located = (
        read(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    return located.withColumn("load", _loads("c_custkey % 7 = 0")).selectExpr(
        "cast(c_custkey as string) as customer_id",
        "concat('  ', split_part(c_name, '#', 1)) as first_name",
        "concat(split_part(c_name, '#', 2), ' ') as last_name",
        "concat(if(load = 1, 'New.', ''), replace(c_name, '#', '.'), '@Example.com ') as email",
        "concat('+', cast(c_nationkey as string), '-', cast(c_custkey as string)) as phone",
        "concat(cast(c_custkey as string), ' ', c_mktsegment, ' street, ', n_name, ', ', r_name) as address",
        "n_name as city",
        "concat(' ', c_mktsegment) as state",
        "r_name as country",
        "lpad(cast(c_custkey % 100000 as string), 5, '0') as postal_code",
        "timestamp'1994-01-01' + make_dt_interval(cast(c_custkey % 365 as int)) as created_at",
        "timestamp'1994-01-01' + make_dt_interval(cast(c_custkey % 365 as int) + load) as updated_at",
        "timestamp'2001-07-01' + make_dt_interval(load) as _ingested_at",
    )


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation")
    located = read(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return located.withColumn("load", _loads("s_suppkey % 5 = 0")).selectExpr(
        "cast(s_suppkey as string) as supplier_id",
        "concat(s_name, ' ') as supplier_name",
        "if(s_suppkey % 3 = 0, null, concat('Contact ', cast(s_suppkey as string))) as contact_name",
        "concat(replace(s_name, '#', '.'), if(load = 1, '.new', ''), '@Example.com') as email",
        "concat('+', cast(s_nationkey as string)) as phone",
        "concat(cast(s_suppkey as string), ' dock road') as address",
        "n_name as city",
        "concat(' ', n_name, ' ') as country",
        "timestamp'1993-01-01' + make_dt_interval(cast(s_suppkey % 365 as int)) as created_at",
        "timestamp'2001-07-01' + make_dt_interval(load) as _ingested_at",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    offered = read(spark, folder, "lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("s_key"))
    parts = read(spark, folder, "part").join(offered, F.col("p_partkey") == F.col("l_partkey"), "left")
    return parts.withColumn("load", _loads("p_partkey % 9 = 0")).selectExpr(
        "cast(p_partkey as string) as product_id",
        "cast(s_key as string) as supplier_id",
        "concat(' ', p_name) as product_name",
        "concat(p_type, ' ') as category",
        "p_brand as subcategory",
        "cast(p_retailprice as decimal(12,2)) as unit_price",
        "cast(p_size + load as int) as stock_quantity",
        "concat(p_brand, '-', cast(p_partkey as string)) as sku",
        "p_size > 2 as is_active",
        "timestamp'1993-06-01' + make_dt_interval(cast(p_partkey % 365 as int)) as created_at",
        "timestamp'1993-06-01' + make_dt_interval(cast(p_partkey % 365 as int) + load) as updated_at",
        "timestamp'2001-07-01' + make_dt_interval(load) as _ingested_at",
    )


def orders_history(spark: SparkSession, folder: str) -> DataFrame:
    """Times are ISO text; every 33rd order has a newer load whose order date cannot be read."""
    placed = read(spark, folder, "orders").withColumn("load", _loads("o_orderkey % 11 = 0")).selectExpr(
        "*",
        """case when o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED' then 'cancelled'
                when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'refunded'
                when o_orderstatus = 'F' then 'delivered'
                when o_orderstatus = 'O' then 'shipped'
                else 'processing' end as status""",
        "o_orderdate + make_dt_interval(cast(1 + o_orderkey % 7 as int)) as ship_time",
    )
    return placed.selectExpr(
        "cast(o_orderkey as string) as order_id",
        "cast(o_custkey as string) as customer_id",
        "concat(' ', status) as order_status",
        "cast(o_totalprice as decimal(12,2)) as total_amount",
        """element_at(array('credit_card', 'debit_card', 'paypal', 'bank_transfer', 'crypto'),
                      cast(o_orderkey % 5 + 1 as int)) as payment_method""",
        """case when o_orderkey % 4 = 0 then null
                when o_orderkey % 4 = 1 then concat(cast(o_orderkey as string), ' Main St')
                else concat(cast(o_orderkey as string), ' Main St, City', cast(o_orderkey % 10 as string),
                            if(o_orderkey % 4 = 3, ', Country', '')) end as shipping_address""",
        """if(load = 1 and o_orderkey % 33 = 0, 'not-a-date',
              date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")) as order_date""",
        """if(o_orderstatus in ('F', 'O'), date_format(ship_time, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), null)
           as shipped_date""",
        """if(status = 'delivered',
              date_format(ship_time + make_dt_interval(cast(1 + o_orderkey % 5 as int)),
                          "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), null) as delivered_date""",
        """date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'+00:00'") as created_at""",
        "timestamp'2001-07-01' + make_dt_interval(load) as _ingested_at",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Item ids repeat (order and line number do), so the latest one has to be chosen."""
    quantity = "cast(l_quantity as decimal(10,0))"
    price = f"cast(round(cast(l_extendedprice as decimal(12,2)) / {quantity}, 2) as decimal(12,2))"
    rate = "cast(l_discount as decimal(12,4))"
    priced = read(spark, folder, "lineitem").selectExpr("*", f"{price} as price")
    return priced.selectExpr(
        "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as order_item_id",
        "cast(l_orderkey as string) as order_id",
        "cast(l_partkey as string) as product_id",
        "cast(l_quantity as int) as quantity",
        "price as unit_price",
        f"if(l_discount = 0, null, {rate}) as discount",
        f"cast(round({quantity} * price * (1 - {rate}), 2) as decimal(12,2)) as subtotal",
        "cast(l_shipdate as timestamp) as created_at",
        "cast(l_shipdate as timestamp) as _ingested_at",
    )


def orders_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every 97th event time is unreadable, every 13th customer is unknown."""
    return read(spark, folder, "orders").selectExpr(
        "cast(o_orderkey as string) as kafka_key",
        "cast(o_orderkey div 4 as bigint) as kafka_offset",
        "cast(o_orderkey % 4 as int) as kafka_partition",
        f"{_arrival('2001-08-01', 'o_orderkey')} as kafka_timestamp",
        "concat('os-', cast(o_orderkey as string)) as event_id",
        """element_at(array('order_created', ' Order_Updated', 'order_cancelled'), cast(o_orderkey % 3 + 1 as int))
           as event_type""",
        f"""if(o_orderkey % 97 = 0, 'bad', date_format(
              cast(o_orderdate as timestamp) + make_dt_interval(0, 0, 0, cast(o_orderkey % 3600 as decimal(18,6))),
              "{ISO_MICROS}")) as event_timestamp""",
        "cast(o_orderkey as string) as order_id",
        "if(o_orderkey % 13 = 0, concat('x', cast(o_custkey as string)), cast(o_custkey as string)) as customer_id",
        """element_at(array('pending', 'confirmed', 'shipped ', 'delivered', 'Processing'),
                      cast(o_orderkey % 5 + 1 as int)) as order_status""",
        "element_at(array('paypal', 'crypto', 'credit_card'), cast(o_orderkey % 3 + 1 as int)) as payment_method",
        "o_totalprice as total_amount",
        "cast(1 + o_orderkey % 7 as int) as item_count",
        "concat('City', cast(o_orderkey % 10 as string), ' ') as shipping_city",
        "if(o_orderkey % 2 = 0, 'US', 'DE') as shipping_country",
        "'postgres_cdc' as source",
        "cast(o_orderdate as timestamp) + make_dt_interval(1) as ingested_at",
        "cast(o_orderdate as timestamp) + make_dt_interval(2) as _loaded_at",
        "concat('part-', cast(o_orderkey % 8 as string), '.parquet') as _source_file",
    )


def clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions are user and day; a third of the clicks carries no user."""
    click = "element_at(map({}), event_type)".format(", ".join(f"'{k}', '{v}'" for k, v in EVENT_TYPES.items()))
    clicks = read(spark, folder, "events").selectExpr("*", f"{click} as click", "cast(ts as timestamp) as time")
    return clicks.selectExpr(
        "cast(event_id as string) as kafka_key",
        "cast(event_id div 4 as bigint) as kafka_offset",
        "cast(event_id % 4 as int) as kafka_partition",
        f"{_arrival('2024-01-31', 'event_id')} as kafka_timestamp",
        "concat('ce-', lpad(cast(event_id as string), 12, '0')) as event_id",
        "concat(click, ' ') as event_type",
        f"""if(event_id % 89 = 0, 'yesterday', date_format(time, "{ISO_MICROS}")) as event_timestamp""",
        "concat(cast(user_id as string), '-', date_format(time, 'yyyyMMdd')) as session_id",
        """case when event_id % 10 < 3 then null
                when event_id % 50 = 7 then 'Guest '
                else cast(user_id as string) end as user_id""",
        """case click when 'product_view' then concat('/products/', cast(event_id % 200 as string))
                      when 'add_to_cart' then '/cart'
                      when 'checkout' then if(event_id % 2 = 0, '/checkout', '/checkout/payment')
                      when 'purchase' then '/checkout/confirmation'
                      else concat('/page/', cast(event_id % 5 as string)) end as page_url""",
        "if(click in ('product_view', 'add_to_cart', 'purchase'), cast(event_id % 200 as string), null) as product_id",
        "if(event_id % 6 = 0, null, concat(' Category ', cast(event_id % 10 as string))) as category",
        "element_at(array('Desktop', ' mobile', 'tablet'), cast(event_id % 3 + 1 as int)) as device_type",
        """element_at(array('Chrome', 'Safari', 'Firefox', 'Edge', 'Samsung Internet'),
                      cast(event_id % 5 + 1 as int)) as browser""",
        "if(event_id % 8 >= 5, null, concat('https://ref', cast(event_id % 5 as string), '.example')) as referrer",
        "cast(round(cast(value as decimal(12,2)) * 1000, 0) as bigint) + event_id % 10 as time_on_page_ms",
        "'web_frontend' as source",
        "time + make_dt_interval(0, 1) as ingested_at",
        "time + make_dt_interval(0, 2) as _loaded_at",
        "concat('part-', cast(event_id % 8 as string), '.parquet') as _source_file",
    )


def inventory_updates(spark: SparkSession, folder: str) -> DataFrame:
    moved = read(spark, folder, "lineitem").selectExpr(
        "*",
        "cast(l_orderkey % 60 as int) as held",
        """case l_returnflag when 'R' then cast(l_quantity as int)
                             when 'A' then -cast(l_quantity as int) else 0 end as moved""",
        "cast(l_shipdate as timestamp) as time",
    )
    kinds = "case l_returnflag when 'R' then {} when 'A' then {} else {} end"
    return moved.selectExpr(
        "cast(l_partkey as string) as kafka_key",
        "l_orderkey as kafka_offset",
        "cast(l_partkey % 4 as int) as kafka_partition",
        f"{_arrival('2001-11-05', '(l_orderkey + l_linenumber)')} as kafka_timestamp",
        "concat_ws('-', 'inv', l_orderkey, l_linenumber, l_partkey, l_suppkey) as event_id",
        f"{kinds.format(repr('restock'), repr('Sale_deduction'), repr('adjustment'))} as event_type",
        f"""date_format(time, "{ISO_MICROS}") as event_timestamp""",
        "cast(l_partkey as string) as product_id",
        "concat('SKU-', cast(l_partkey as string), ' ') as sku",
        """element_at(array('WH-EAST-01', 'WH-WEST-01', 'WH-CENTRAL-01', 'WH-SOUTH-01'),
                      cast(l_suppkey % 4 + 1 as int)) as warehouse_id""",
        "held as quantity_before",
        "moved as quantity_change",
        "if(l_orderkey % 50 = 49, null, greatest(0, held + moved)) as quantity_after",
        f"{kinds.format(repr('supplier_delivery'), repr('order_fulfilled'), repr('inventory_audit'))} as reason",
        f"{kinds.format(repr('system'), repr('order_fulfillment'), repr('manual'))} as triggered_by",
        "'inventory_service' as source",
        "time + make_dt_interval(0, 1) as ingested_at",
        "time + make_dt_interval(0, 2) as _loaded_at",
        "concat('part-', cast(l_partkey % 8 as string), '.parquet') as _source_file",
    )


RAW = {
    "customers": customers,
    "suppliers": suppliers,
    "products": products,
    "orders_history": orders_history,
    "order_items": order_items,
    "orders_stream": orders_stream,
    "clickstream": clickstream,
    "inventory_updates": inventory_updates,
}


class RawTables(dict):
    """Raw tables by name, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        self[name] = RAW[name](self.spark, self.folder)
        return self[name]


def warehouse(spark: SparkSession, folder: str, rules: Rules = RULES) -> Warehouse:
    return Warehouse(RawTables(spark, folder), rules)
