"""Order of monthly results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_month(frame: DataFrame, year: str, month: str) -> DataFrame:
    """Sort a monthly result, unknown months last."""
    return frame.orderBy(F.asc_nulls_last(year), F.asc_nulls_last(month))


def month_order() -> WindowSpec:
    """All months in order: for running totals over results of one row per month.

    Such a window runs in one task; the calendar bounds its input.
    """
    return Window.orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
