"""Money expressions over integer cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_units(cents: str) -> Column:
    """Cents column to whole currency units, truncated toward zero."""
    return F.expr(f"`{cents}` div 100")


def fractional_units(cents: Column) -> Column:
    """Cents to currency units as a double."""
    return cents.cast("double") / F.lit(100.0)


def net_units(amount: Column, discount: Column) -> Column:
    """Line amount less discount in whole units, halves rounded to even; NULL counts as 0."""
    zero = F.lit(0.0)
    gross = F.coalesce(amount.cast("double"), zero)
    off = F.coalesce(discount.cast("double"), zero)
    return F.rint((gross - off) / F.lit(100.0))


def monthly_share(total: Column) -> Column:
    """A yearly total's share of one month, halves rounded to even."""
    return F.rint(total / F.lit(12.0))
