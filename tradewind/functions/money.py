"""Decimal arithmetic. Money is never summed as floating point: sums must not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

AMOUNT = "decimal(12,2)"
FRACTION = "decimal(12,4)"
DERIVED = "decimal(18,2)"  # line revenue, movement value: still fits in one 64-bit word
TOTAL = "decimal(28,2)"    # sums


def amount(name: str) -> Column:
    return F.col(name).cast(AMOUNT).alias(name)


def fraction(name: str) -> Column:
    """Discount share of the price; missing means no discount."""
    return F.coalesce(F.col(name).cast(FRACTION), F.lit(0).cast(FRACTION)).alias(name)


def net_unit_price(price: str, discount: str) -> Column:
    return F.round(F.col(price).cast(FRACTION) * (F.lit(1) - fraction(discount)), 2).cast(DERIVED)


def line_subtotal(quantity: str, price: str, discount: str) -> Column:
    """Stored subtotal of an order line: quantity x price x (1 - discount), to the cent."""
    gross = F.col(quantity).cast("decimal(10,0)") * F.col(price).cast(AMOUNT)
    return F.round(gross * (F.lit(1) - fraction(discount)), 2).cast(AMOUNT)


def cents_to_dollars(cents: Column, scale: int = 2) -> Column:
    return F.round(cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)"), scale)


def total(value: Column) -> Column:
    """Sum of money, or of partial sums of money."""
    return F.sum(value).cast(TOTAL)


def average(sum_of: Column, count_of: Column, scale: int = 6) -> Column:
    """Exact decimal mean from a sum and a count, half away from zero; NULL over no rows."""
    quotient = F.try_divide(sum_of.cast("decimal(28,4)"), count_of.cast("decimal(13,0)"))
    return F.round(quotient, scale).cast(f"decimal({22 + scale},{scale})")


def share(part: Column, whole: Column, scale: int = 4) -> Column:
    """part / whole rounded half away from zero; NULL when the whole is zero."""
    quotient = F.try_divide(part.cast("decimal(18,0)"), whole.cast("decimal(18,0)"))
    return F.round(quotient, scale).cast(f"decimal({12 + scale},{scale})")
