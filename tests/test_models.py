"""Business rules on hand-made rows, with the default thresholds."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from samples import LOADED, by, orders, raw
from tradewind.plans import intermediate, marts, staging
from tradewind.plans.warehouse import Rules, Warehouse
from tradewind.registry.contract import MODEL_COLUMNS

AS_OF = datetime(2024, 6, 1)
LATER = datetime(2024, 3, 2)


@pytest.fixture(scope="module")
def house(spark):
    """Three customers, four products, five orders and their lines, clicks and stock movements."""
    tables = {
        "customers": raw(
            spark, "customers",
            dict(customer_id="c1", first_name=" Ada ", last_name="Byron", email=" ADA@X.ORG ", country="UK",
                 created_at=datetime(2024, 1, 1)),
            dict(customer_id="c1", first_name="Ada", last_name="Lovelace", email="ada@x.org", country="UK",
                 created_at=datetime(2024, 1, 1), _ingested_at=LATER),
            dict(customer_id="c2", first_name=None, last_name="Solo", email="s@x.org", country="DE",
                 created_at=datetime(2024, 1, 1)),
            dict(customer_id="c3", first_name="No", last_name="Orders", email="n@x.org", country="DE",
                 created_at=datetime(2024, 1, 1)),
            dict(customer_id=None, first_name="Dropped")),
        "suppliers": raw(spark, "suppliers", dict(supplier_id="s1", supplier_name=" Acme ", country="US")),
        "products": raw(
            spark, "products",
            dict(product_id="p1", supplier_id="s1", product_name="Lamp", category="Home", unit_price="100.00",
                 stock_quantity=60, is_active=True),
            dict(product_id="p2", supplier_id="s1", product_name="Book", category="Books", unit_price="10.00",
                 stock_quantity=5, is_active=True),
            dict(product_id="p3", supplier_id="zz", product_name="Unsold", category="Home", unit_price="1.00",
                 stock_quantity=0, is_active=False)),
        "orders_history": orders(
            spark,
            dict(order_id="o1", customer_id="c1", order_status=" delivered ", payment_method="paypal",
                 total_amount="500.00", order_date="2024-05-01T23:00:00+00:00", shipped_date="2024-05-02T01:00:00+00:00"),
            dict(order_id="o1", customer_id="c1", order_status="cancelled", total_amount="500.00",
                 order_date="broken", _ingested_at=LATER),
            dict(order_id="o2", customer_id="c1", order_status="cancelled", payment_method="paypal",
                 total_amount="99.99", order_date="2024-05-02T00:00:00+00:00"),
            dict(order_id="o3", customer_id="c2", order_status="refunded", payment_method="crypto",
                 total_amount="100.00", order_date="2024-03-02T00:00:00+00:00"),
            dict(order_id="o4", customer_id="gone", order_status="returned", payment_method="credit_card",
                 total_amount=None, order_date="2024-05-01T00:00:00+00:00"),
            dict(order_id=None, customer_id="c1", order_date="2024-05-01T00:00:00+00:00")),
        "order_items": raw(
            spark, "order_items",
            dict(order_item_id="i1", order_id="o1", product_id="p1", quantity=2, unit_price="100.00",
                 discount="0.1500", subtotal="170.00"),
            dict(order_item_id="i2", order_id="o1", product_id="p2", quantity=50, unit_price="10.00", discount=None,
                 subtotal="500.00"),
            dict(order_item_id="i3", order_id="o2", product_id="p1", quantity=1, unit_price="100.00", discount=None),
            dict(order_item_id="i4", order_id="nowhere", product_id="p1", quantity=9, unit_price="100.00"),
            dict(order_item_id="i5", order_id="o4", product_id="unknown", quantity=1, unit_price="7.00")),
        "orders_stream": raw(
            spark, "orders_stream",
            dict(event_id="e1", event_timestamp="2024-05-01T00:00:00+00:00", customer_id="c1", total_amount=500.0),
            dict(event_id="e2", event_timestamp="2024-05-01T00:00:00+00:00", customer_id="nobody", total_amount=1.0),
            dict(event_id="e3", event_timestamp="2024-05-01T00:00:00+00:00", customer_id=None),
            dict(event_id="e4", event_timestamp="soon", customer_id="c1"),
            dict(event_id=None, event_timestamp="2024-05-01T00:00:00+00:00")),
        "clickstream": raw(spark, "clickstream", *[
            dict(event_id=f"k{number:02}", session_id=session, event_type=kind, user_id=user, page_url=page,
                 event_timestamp=f"2024-05-01T00:00:{number:02}.900000+00:00", time_on_page_ms=ms,
                 product_id=product, device_type=device)
            for number, (session, kind, user, page, ms, product, device) in enumerate([
                ("bounce", "page_view", None, "/", 1005, None, " Mobile"),
                ("bounce", "page_view", "Guest ", "/", 995, None, "desktop"),
                ("bounce", "page_view", None, "/a", None, None, "desktop"),
                ("bounce", "page_view", None, "/b", 0, None, "desktop"),
                ("active", "product_view", None, "/", 10, "p1", "tablet"),
                ("active", "product_view", None, "/", 10, "p1", "tablet"),
                ("active", "product_view", "u2", "/", 10, "p2", "tablet"),
                ("active", "product_view", "c1", "/", 10, None, "tablet"),
                ("active", "product_view", "c1", "/", 10, None, "tablet"),
                ("cart", "add_to_cart", "b", "/cart", 10, "p1", "tablet"),
                ("cart", "page_view", "a", "/", 10, "p1", "tablet"),
                ("checkout", "checkout", None, "/checkout", 10, None, "tablet"),
                ("buyer", " Purchase ", "c1", "/done", 10, None, "tablet"),
                (None, "page_view", "c2", "/lost", 10, None, "tablet"),
                (None, "page_view", "c2", "/lost", 10, None, "tablet"),
            ])]),
        "inventory_updates": raw(
            spark, "inventory_updates",
            dict(event_id="m1", event_timestamp="2024-05-01T00:00:00+00:00", product_id="p1", quantity_change=101,
                 quantity_after=161),
            dict(event_id="m2", event_timestamp="2024-05-02T00:00:00+00:00", product_id="p1", quantity_change=-160,
                 quantity_after=1),
            dict(event_id="m3", event_timestamp="2024-05-03T00:00:00+00:00", product_id="ghost", quantity_change=None,
                 quantity_after=None),
            dict(event_id="m4", event_timestamp="n/a", product_id="p1", quantity_change=1, quantity_after=9)),
    }
    return Warehouse(tables, Rules(as_of=AS_OF))


@pytest.mark.parametrize("model", MODEL_COLUMNS)
def test_columns(house, model):
    assert house.model(model).columns == MODEL_COLUMNS[model]


def test_latest_customer_is_kept_and_cleaned(house):
    people = by("customer_id", house.stg_customers)
    assert set(people) == {"c1", "c2", "c3"}
    assert people["c1"]["full_name"] == "Ada Lovelace"
    assert people["c2"]["full_name"] == " Solo"


def test_ties_are_broken_the_same_way_whatever_the_order(spark):
    rows = [dict(customer_id="c", email=f"{n}@x.org", city="Z" if n == 3 else None) for n in range(6)]
    picked = {
        staging.stg_customers(raw(spark, "customers", *order).repartition(parts)).first()["email"]
        for order, parts in ((rows, 1), (rows[::-1], 3), (rows[2:] + rows[:2], 5))
    }
    assert picked == {"5@x.org"}


def test_older_readable_order_survives(house):
    staged = by("order_id", house.stg_orders_history)
    assert set(staged) == {"o1", "o2", "o3", "o4"}
    assert staged["o1"]["order_status"] == "DELIVERED" and staged["o1"]["days_to_ship"] == 1
    assert staged["o2"]["days_to_ship"] is None


def test_order_lines(house):
    lines = by("order_item_id", house.int_order_lines)
    assert set(lines) == {"i1", "i2", "i3", "i5"}  # i4 has no order
    first = lines["i1"]
    assert (first["effective_unit_price"], first["line_revenue"], first["discount_amount"]) == (
        Decimal("85.00"), Decimal("170.00"), Decimal("30.00"))
    assert first["is_discounted"] and first["is_delivered"] and not lines["i2"]["is_discounted"]
    assert lines["i2"]["discount"] == 0 and lines["i5"]["product_name"] is None


def test_orders_with_customers(house):
    placed = by("order_id", house.int_orders_with_customers)
    assert {key: row["order_value_tier"] for key, row in placed.items()} == {
        "o1": "high", "o2": "low", "o3": "medium", "o4": "low"}
    assert placed["o1"]["customer_tenure_days_at_order"] == 121
    assert placed["o4"]["customer_full_name"] is None


def test_stream_orders(house):
    events = by("event_id", house.int_streaming_orders_enriched)
    assert {key: row["customer_matched"] for key, row in events.items()} == {"e1": True, "e2": False, "e3": False}
    assert events["e3"]["order_value_tier"] == "low"


def test_sessions(house):
    sessions = by("session_id", house.int_clickstream_sessionized)
    assert set(sessions) == {"bounce", "active", "cart", "checkout", "buyer", None}
    got = {key: (row["funnel_stage"], row["session_quality"]) for key, row in sessions.items()}
    assert got == {
        "bounce": ("browse_only", "bounce"), "active": ("product_view", "active"), "cart": ("add_to_cart", "engaged"),
        "checkout": ("checkout", "bounce"), "buyer": ("purchase", "converted"), None: ("browse_only", "bounce")}
    bounce, active = sessions["bounce"], sessions["active"]
    assert (bounce["device_type"], bounce["entry_page"], bounce["exit_page"]) == ("mobile", "/", "/b")
    assert bounce["unique_pages_viewed"] == 3 and bounce["unique_products_viewed"] == 0
    assert bounce["total_time_on_site_sec"] == Decimal("2.01")  # 1.01 + 1.00 + 0
    assert bounce["avg_time_per_page_sec"] == Decimal("0.670000") and bounce["session_duration_sec"] == 3
    assert bounce["has_authenticated_event"] is False and active["has_authenticated_event"] is True
    assert active["user_id"] == "c1" and active["unique_products_viewed"] == 2
    assert sessions["cart"]["user_id"] == "a"  # tie: the smaller one
    assert sessions["checkout"]["user_id"] is None
    assert sessions[None]["total_events"] == 2 and sessions[None]["user_id"] == "c2"


def test_inventory(house):
    moves = by("event_id", house.int_inventory_enriched)
    assert set(moves) == {"m1", "m2", "m3"}
    assert moves["m1"]["movement_value"] == Decimal("10100.00") and moves["m1"]["is_large_movement"]
    assert (moves["m2"]["stock_health"], moves["m2"]["supplier_name"]) == ("critical", "Acme")
    assert (moves["m3"]["movement_type"], moves["m3"]["stock_health"]) == ("adjustment", "healthy")


def test_mart_orders(house):
    placed = by("order_id", house.mart_orders)
    first = placed["o1"]
    assert first["primary_category"] == "Books"  # one line each: the smaller one, quantity does not count
    assert (first["line_item_count"], first["total_units"], first["distinct_products"]) == (2, 52, 2)
    assert first["avg_discount_rate"] == Decimal("0.07500000") and first["has_discounted_item"]
    assert (first["order_date_day"], first["order_day_of_week"]) == (date(2024, 5, 1), 4)
    assert placed["o3"]["line_item_count"] == 0 and placed["o3"]["has_discounted_item"] is None
    assert placed["o4"]["distinct_products"] == 1 and placed["o4"]["distinct_categories"] == 0


def test_mart_customers(house):
    people = by("customer_id", house.mart_customers)
    ada, solo, none = people["c1"], people["c2"], people["c3"]
    assert (ada["lifetime_value"], ada["customer_segment"]) == (Decimal("599.99"), "silver")  # cancelled order counts
    assert (ada["delivery_rate"], ada["cancellation_rate"]) == (Decimal("0.5000"), Decimal("0.5000"))
    assert ada["is_active_customer"] and ada["days_since_last_order"] == 30
    assert solo["days_since_last_order"] == 91 and not solo["is_active_customer"]
    assert (none["customer_segment"], none["total_orders"], none["delivery_rate"]) == ("prospect", 0, None)
    assert none["is_active_customer"] is False and none["days_since_last_order"] is None


def test_active_for_ninety_days(house):
    rules = Rules(as_of=datetime(2024, 5, 31))
    people = by("customer_id", Warehouse(house.raw, rules).mart_customers)
    assert people["c2"]["days_since_last_order"] == 90 and people["c2"]["is_active_customer"]


def test_mart_products(house):
    items = by("product_id", house.mart_products)
    lamp, book, unsold = items["p1"], items["p2"], items["p3"]
    assert (lamp["total_orders"], lamp["total_units_sold"], lamp["total_revenue"]) == (1, 2, Decimal("170.00"))
    assert (lamp["current_stock"], lamp["current_stock_health"], lamp["total_units_depleted"]) == (1, "critical", 160)
    assert lamp["performance_tier"] == "low_performer" and lamp["revenue_per_unit_sold"] == Decimal("85.00")
    assert (book["current_stock"], book["current_stock_health"]) == (5, "critical")  # no event: the catalogue's
    assert (unsold["performance_tier"], unsold["current_stock_health"]) == ("no_sales", "out_of_stock")
    assert unsold["revenue_per_unit_sold"] == 0 and unsold["supplier_name"] is None


def test_mart_products_takes_enriched_inputs_as_well(house):
    full = marts.mart_products(house.stg_products, house.stg_suppliers, house.int_order_lines,
                               house.int_inventory_enriched)
    assert sorted(full.collect(), key=str) == sorted(house.mart_products.collect(), key=str)


def test_mart_revenue_daily(house):
    days = by("date_day", house.mart_revenue_daily)
    assert set(days) == {date(2024, 5, 1)}  # cancelled and refunded days are gone, returned counts
    day = days[date(2024, 5, 1)]
    assert (day["total_orders"], day["unique_customers"], day["gross_revenue"]) == (2, 2, Decimal("500.00"))
    assert day["avg_order_value"] == Decimal("500.000000")  # the order without a total does not count
    assert (day["high_value_orders"], day["low_value_orders"], day["paypal_orders"]) == (1, 1, 1)
    assert (day["top_customer_country"], day["avg_days_to_ship"]) == ("UK", Decimal("1.000000"))


def test_mart_funnel(house):
    funnel = by("session_id", house.mart_funnel)
    assert funnel["buyer"]["is_known_customer"] and funnel["buyer"]["funnel_stage_num"] == 5
    assert funnel["active"]["customer_full_name"] == "Ada Lovelace"
    assert funnel["cart"]["cart_abandoned"] and not funnel["buyer"]["cart_abandoned"]
    assert funnel["checkout"]["checkout_abandoned"] and not funnel["checkout"]["is_known_customer"]
    assert funnel["bounce"]["funnel_stage_num"] == 1 and funnel["bounce"]["session_date"] == date(2024, 5, 1)


def test_empty_inputs(spark):
    empty = Warehouse({name: raw(spark, name).limit(0) if name != "orders_history" else orders(spark).limit(0)
                       for name in ("customers", "suppliers", "products", "orders_history", "order_items",
                                    "orders_stream", "clickstream", "inventory_updates")}, Rules(as_of=AS_OF))
    assert all(empty.model(name).count() == 0 for name in ("mart_customers", "mart_products", "mart_funnel",
                                                            "mart_revenue_daily"))


def test_load_time_is_kept(house):
    assert {row["_ingested_at"] for row in house.stg_suppliers.collect()} == {LOADED}
    assert intermediate.with_stock_health(house.stg_inventory_updates).count() == 3
