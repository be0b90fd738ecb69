"""Reading the JSON text columns of the JSON layout.

Fields are read as text and cast afterwards, so that a number may be quoted or not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(document: Column, name: str) -> Column:
    """Text of one top-level field, NULL when absent or JSON null."""
    return F.get_json_object(document, f"$['{name}']")


def epoch_range(period: Column) -> Column:
    """A `{"start": n, "end": n}` document as a struct of longs, parsed once.

    The struct is cast as a whole: casts of its fields would each become a parse of its own.
    """
    parsed = F.from_json(period, "`start` STRING, `end` STRING")
    return parsed.cast("struct<`start`: bigint, `end`: bigint>")


def first_amount(amounts: Column) -> Column:
    """`amount` of the first element of a `[{"amount": n}, ...]` document."""
    return F.get_json_object(amounts, "$[0].amount").cast("double")
