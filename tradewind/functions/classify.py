"""Business classes. Default thresholds are the fixed business values; callers may pass others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values.
TIER_FLOORS = (500, 100)
SEGMENT_FLOORS = (2000, 1000, 500)
STOCK_CEILINGS = (10, 50)
PERFORMANCE_FLOORS = (10000, 5000, 1000)
ACTIVE_DAYS = 90
LARGE_MOVEMENT = 100
ACTIVE_SESSION_EVENTS = 5
FUNNEL_STAGES = ("browse_only", "product_view", "add_to_cart", "checkout", "purchase")


def by_floor(value: Column, floors: Sequence, labels: Sequence[str], otherwise) -> Column:
    """Label of the first floor (highest first) that the value reaches."""
    result = None
    for floor, label in zip(floors, labels, strict=True):
        branch = value >= F.lit(floor)
        result = F.when(branch, label) if result is None else result.when(branch, label)
    return result.otherwise(otherwise)


def order_value_tier(amount: Column, floors: Sequence = TIER_FLOORS) -> Column:
    """An unknown amount counts as low."""
    return by_floor(amount, floors, ("high", "medium"), "low")


def customer_segment(lifetime_value: Column, orders: Column, floors: Sequence = SEGMENT_FLOORS) -> Column:
    rest = F.when(orders > 0, "bronze").otherwise("prospect")
    return by_floor(lifetime_value, floors, ("platinum", "gold", "silver"), rest)


def performance_tier(revenue: Column, floors: Sequence = PERFORMANCE_FLOORS) -> Column:
    rest = F.when(revenue > 0, "low_performer").otherwise("no_sales")
    return by_floor(revenue, floors, ("top_performer", "strong", "moderate"), rest)


def stock_health(quantity: Column, ceilings: Sequence = STOCK_CEILINGS) -> Column:
    """An unknown quantity counts as healthy."""
    critical, low = ceilings
    return (
        F.when(quantity == 0, "out_of_stock")
        .when(quantity <= critical, "critical")
        .when(quantity <= low, "low")
        .otherwise("healthy")
    )


def movement_type(change: Column) -> Column:
    """An unknown change counts as an adjustment."""
    return F.when(change > 0, "restock").when(change < 0, "depletion").otherwise("adjustment")


def is_true(condition: Column) -> Column:
    """Two-valued condition: unknown is false."""
    return F.coalesce(condition, F.lit(False))


def is_large_movement(change: Column, limit: int = LARGE_MOVEMENT) -> Column:
    return is_true(F.abs(change) > limit)


def status_flags(status: Column) -> dict[str, Column]:
    return {
        "is_delivered": is_true(status == "DELIVERED"),
        "is_cancelled": is_true(status == "CANCELLED"),
        "is_refunded": is_true(status == "REFUNDED"),
    }


def kept_sale() -> Column:
    """Sales that count: neither cancelled nor refunded. Returned orders do count."""
    return ~F.col("is_cancelled") & ~F.col("is_refunded")


def funnel_stage(reached: dict[str, Column]) -> Column:
    """Furthest stage whose flag is set."""
    result = None
    for stage in reversed(FUNNEL_STAGES[1:]):
        result = F.when(reached[stage], stage) if result is None else result.when(reached[stage], stage)
    return result.otherwise(FUNNEL_STAGES[0])


def funnel_stage_number(stage: Column) -> Column:
    result = None
    for number, name in enumerate(FUNNEL_STAGES, start=1):
        result = F.when(stage == name, number) if result is None else result.when(stage == name, number)
    return result


def session_quality(purchased: Column, carted: Column, events: Column,
                    active_events: int = ACTIVE_SESSION_EVENTS) -> Column:
    return (
        F.when(purchased, "converted")
        .when(carted, "engaged")
        .when(events >= active_events, "active")
        .otherwise("bounce")
    )
