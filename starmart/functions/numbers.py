"""Number expressions; money stays decimal and rounds half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The decimal types of the warehouse tables.
PRICE = "decimal(10,2)"
DISCOUNT = "decimal(5,4)"
AMOUNT = "decimal(12,2)"


def repaired_discount(c: Column) -> Column:
    """0 where missing, the positive value where negative."""
    return F.coalesce(F.abs(c), F.lit(0).cast(DISCOUNT))


def line_amount(unit_price: Column, quantity: Column, discount: Column) -> Column:
    # Price first: that product still fits the short decimal form, which is the fast one.
    return F.round(unit_price * (F.lit(1) - discount) * quantity, 2).cast(AMOUNT)


def freight_share(freight: Column, line_count: Column) -> Column:
    """An order's freight split evenly over its lines."""
    return F.round(freight / line_count, 2).cast(PRICE)


def ratio(a: Column, b: Column, digits: int) -> Column:
    """a / b, NULL where b is 0."""
    return F.round(a / F.nullif(b, F.lit(0)), digits)


def percent(a: Column, b: Column, digits: int) -> Column:
    """100 * a / b, NULL where b is 0."""
    return F.round(a / F.nullif(b, F.lit(0)) * 100, digits)
