"""Output columns of the models and how result values are rendered for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

CUSTOMER = "customer_full_name customer_email customer_city customer_state customer_country"
BROKER = "kafka_offset kafka_partition kafka_timestamp"
SESSION = (
    "total_events unique_pages_viewed unique_products_viewed unique_categories_viewed "
    "total_time_on_site_sec avg_time_per_page_sec entry_page exit_page referrer "
    "has_page_view has_product_view has_add_to_cart has_checkout has_purchase funnel_stage session_quality"
)

# The columns of every model, in order.
MODEL_COLUMNS = {name: columns.split() for name, columns in {
    "stg_customers": "customer_id first_name last_name full_name email phone address city state country "
                     "postal_code created_at updated_at _ingested_at",
    "stg_products": "product_id supplier_id product_name category subcategory sku unit_price stock_quantity "
                    "is_active created_at updated_at _ingested_at",
    "stg_suppliers": "supplier_id supplier_name contact_name email phone address city country created_at "
                     "_ingested_at",
    "stg_orders_history": "order_id customer_id order_status payment_method shipping_address total_amount "
                          "order_date shipped_date delivered_date created_at _ingested_at days_to_ship",
    "stg_order_items": "order_item_id order_id product_id quantity unit_price discount subtotal "
                       "effective_unit_price created_at _ingested_at",
    "stg_orders_stream": "event_id event_type event_timestamp order_id customer_id order_status payment_method "
                         f"total_amount item_count shipping_city shipping_country {BROKER} event_source "
                         "ingested_at _loaded_at _source_file",
    "stg_clickstream": "event_id session_id event_type event_timestamp user_id is_anonymous page_url product_id "
                       f"category device_type browser referrer time_on_page_ms time_on_page_sec {BROKER} "
                       "event_source ingested_at _loaded_at _source_file",
    "stg_inventory_updates": "event_id event_type event_timestamp product_id sku warehouse_id quantity_before "
                             f"quantity_change quantity_after movement_type reason triggered_by {BROKER} "
                             "event_source ingested_at _loaded_at _source_file",
    "int_order_lines": "order_item_id order_id product_id customer_id order_status payment_method order_date "
                       "shipped_date delivered_date days_to_ship product_name category subcategory sku "
                       "supplier_id product_is_active quantity listed_unit_price discount effective_unit_price "
                       "subtotal line_revenue discount_amount is_discounted is_delivered is_cancelled "
                       "is_refunded item_created_at _ingested_at",
    "int_orders_with_customers": f"order_id customer_id {CUSTOMER} customer_since customer_tenure_days_at_order "
                                 "order_status payment_method total_amount shipping_address order_date "
                                 "shipped_date delivered_date days_to_ship is_delivered is_cancelled is_refunded "
                                 "order_value_tier order_created_at _ingested_at",
    "int_streaming_orders_enriched": "event_id event_type event_timestamp event_source order_id customer_id "
                                     "order_status payment_method total_amount item_count shipping_city "
                                     f"shipping_country {CUSTOMER} customer_matched order_value_tier {BROKER} "
                                     "ingested_at _loaded_at",
    "int_clickstream_sessionized": "session_id user_id has_authenticated_event device_type browser session_start "
                                   f"session_end session_duration_sec {SESSION}",
    "int_inventory_enriched": "event_id event_type event_timestamp movement_type reason triggered_by warehouse_id "
                              "product_id sku product_name category subcategory unit_price product_is_active "
                              "supplier_id supplier_name supplier_country quantity_before quantity_change "
                              f"quantity_after movement_value stock_health is_large_movement {BROKER} ingested_at "
                              "_loaded_at",
    "mart_orders": f"order_id customer_id {CUSTOMER} customer_since customer_tenure_days_at_order order_status "
                   "payment_method order_value_tier order_date shipped_date delivered_date days_to_ship "
                   "is_delivered is_cancelled is_refunded total_amount total_line_revenue total_discount_amount "
                   "avg_discount_rate line_item_count total_units distinct_products distinct_categories "
                   "has_discounted_item primary_category order_date_day order_week order_month order_year "
                   "order_month_num order_day_of_week order_created_at _ingested_at",
    "mart_customers": "customer_id full_name email phone city state country postal_code customer_since "
                      "total_orders delivered_orders cancelled_orders refunded_orders lifetime_value "
                      "avg_order_value max_order_value total_discounts_received first_order_date last_order_date "
                      "days_between_first_last_order preferred_payment_method preferred_category "
                      "typical_order_tier days_since_last_order customer_segment is_active_customer delivery_rate "
                      "cancellation_rate _ingested_at",
    "mart_products": "product_id product_name category subcategory sku unit_price is_active supplier_id "
                     "supplier_name supplier_country total_orders total_units_sold total_revenue "
                     "avg_revenue_per_order total_discount_given avg_discount_rate unique_customers "
                     "first_sale_date last_sale_date current_stock current_stock_health total_inventory_events "
                     "total_units_restocked total_units_depleted last_inventory_update revenue_per_unit_sold "
                     "performance_tier created_at _ingested_at",
    "mart_revenue_daily": "date_day order_week order_month order_year order_month_num order_day_of_week "
                          "total_orders unique_customers total_units_sold gross_revenue net_revenue "
                          "total_discounts avg_order_value high_value_orders medium_value_orders low_value_orders "
                          "credit_card_orders debit_card_orders paypal_orders bank_transfer_orders "
                          "top_customer_country delivered_orders avg_days_to_ship",
    "mart_funnel": "session_id user_id customer_full_name customer_email customer_country "
                   "has_authenticated_event is_known_customer device_type browser session_start session_end "
                   "session_duration_sec session_date session_week session_month session_hour "
                   f"{SESSION} funnel_stage_num converted cart_abandoned checkout_abandoned",
}.items()}

# How a column's values are compared: decimals as doubles, times and dates as text.
TIMES = set(
    "created_at updated_at _ingested_at order_date shipped_date delivered_date event_timestamp kafka_timestamp "
    "ingested_at _loaded_at item_created_at customer_since order_created_at session_start session_end order_week "
    "order_month session_week session_month first_order_date last_order_date first_sale_date last_sale_date "
    "last_inventory_update valid_from valid_to snapshotted_at date_week date_month date_year newest_row "
    "last_extracted_at".split()
)
DATES = {"order_date_day", "date_day", "session_date"}
DECIMALS = set(
    "unit_price total_amount discount subtotal effective_unit_price time_on_page_sec listed_unit_price "
    "line_revenue discount_amount movement_value total_time_on_site_sec avg_time_per_page_sec total_line_revenue "
    "total_discount_amount avg_discount_rate lifetime_value avg_order_value max_order_value "
    "total_discounts_received delivery_rate cancellation_rate total_revenue avg_revenue_per_order "
    "total_discount_given revenue_per_unit_sold gross_revenue net_revenue total_discounts avg_days_to_ship".split()
)
OPTIONAL_FLAGS = {"has_discounted_item", "product_is_active"}  # rendered as text because they may be NULL

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def rendered(result: DataFrame) -> DataFrame:
    """The result in types whose values compare the same way in every engine."""
    def render(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, TIME_TEXT)
        elif isinstance(field.dataType, T.DateType) or field.name in OPTIONAL_FLAGS:
            column = column.cast("string")
        return column.alias(field.name)

    return result.select(*[render(field) for field in result.schema.fields])


def rendered_sql(columns: list[str] | str) -> str:
    """The same rendering as a DuckDB select list."""
    def render(name: str) -> str:
        quoted = f'"{name}"'
        if name in TIMES:
            return f"strftime({quoted}, '%Y-%m-%d %H:%M:%S.%f') AS {quoted}"
        if name in DATES:
            return f"strftime({quoted}, '%Y-%m-%d') AS {quoted}"
        if name in DECIMALS:
            return f"CAST({quoted} AS DOUBLE) AS {quoted}"
        if name in OPTIONAL_FLAGS:
            return f"CAST({quoted} AS VARCHAR) AS {quoted}"
        return quoted

    names = columns.split() if isinstance(columns, str) else columns
    return ", ".join(map(render, names))
