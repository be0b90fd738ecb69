"""Calendar expressions over epoch seconds and dates, all built-in functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS_IN_YEAR = 12


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a timestamp."""
    return F.timestamp_seconds(seconds)


def epoch_date(seconds: Column) -> Column:
    """Epoch seconds as a calendar day in the session zone."""
    return F.to_date(F.timestamp_seconds(seconds))


def month_starts(first: Column) -> Column:
    """Twelve dates, each one month after the one before.

    A day clipped at a short month stays clipped (31 Jan, 28 Feb, 28 Mar), so every
    date is derived from its predecessor. `sequence` by months would count from the
    first day each time and give 31 Mar. Nested `add_months` stays inside generated
    code, unlike a higher-order function.
    """
    steps = [first]
    for _ in range(MONTHS_IN_YEAR - 1):
        steps.append(F.add_months(steps[-1], 1))
    return F.array(*steps)


def month_label(day: Column) -> Column:
    """English month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(day, "MMMM"), 9, " ")


def clock(as_of: dt.datetime | Column | None) -> Column:
    """The evaluation instant: the given one, or the current time.

    A datetime must carry its zone, so that its instant does not depend on the host.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        raise ValueError("as_of needs a time zone")
    return F.lit(as_of)
