"""Invoice lines of either layout, reduced to the same columns.

In the normalized layout a line is spread over child tables joined on the line hash,
in the JSON layout it is one row with JSON columns. Callers of this module do not see
the difference.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.functions import jsontext
from subtally.functions.dates import epoch_timestamp
from subtally.sources.schemas import HOT_INVOICES, LINE_HASH, SALT
from subtally.sources.tables import BillingTables

SUBSCRIPTION = "subscription"


def invoice_lines(
    t: BillingTables,
    kind: str | None = SUBSCRIPTION,
    period: bool = True,
    product: Literal["price", "plan"] | None = None,
    interval: bool = False,
    discount: bool = False,
    how: str = "inner",
    invoice_column: str = "invoice_id",
    only: DataFrame | None = None,
) -> DataFrame:
    """Lines of one type, or of all, with the asked-for parts.

    Always invoice_id, line_key, type, amount; then line_start and line_end (`period`),
    product (of the line's price or plan), interval, discount. `how` is the join to
    period and price. A line whose plan or interval is missing is dropped when either
    is asked for. `discount` gives a normalized line once per discount row; the JSON layout
    has its discounts per line id, see `with_first_discount`. `only` (one column, invoice_id)
    cuts the lines down to those invoices before the parts are joined.
    """
    lines = t.invoice_line_items
    if kind is not None:
        lines = lines.filter(F.col("type") == kind)
    if t.is_json:
        lines = _of_invoices(lines, only)
        return _json_lines(lines, period, product is not None, interval)
    rows = lines.select(
        F.col(LINE_HASH).alias("line_key"), F.col(invoice_column).alias("invoice_id"), "type", "amount"
    )
    rows = _of_invoices(rows, only)
    extra: list = []
    if interval or product == "plan":
        columns = {"interval": "interval"} if interval else {}
        if product == "plan":
            columns["product"] = "product"
        plan = _child(t, "plan", **columns)
        if interval:
            plan = plan.filter(F.col("interval").isNotNull())
        rows = rows.join(plan, "line_key")
        extra += list(columns)
    if product == "price":
        rows = rows.join(_child(t, "price", product="product"), "line_key", how)
        extra.append("product")
    if period:
        rows = rows.join(_child(t, "period", from_epoch="start", to_epoch="end"), "line_key", how)
        extra.append(epoch_timestamp(F.col("from_epoch")).alias("line_start"))
        extra.append(epoch_timestamp(F.col("to_epoch")).alias("line_end"))
    if discount:
        rows = rows.join(_child(t, "discount_amounts", discount="amount"), "line_key", "left")
        extra.append("discount")
    return rows.select("invoice_id", "line_key", "type", "amount", *extra)


def _of_invoices(lines: DataFrame, only: DataFrame | None) -> DataFrame:
    return lines if only is None else lines.join(only, "invoice_id", "left_semi")


def _child(t: BillingTables, name: str, **columns: str) -> DataFrame:
    table = getattr(t, f"invoice_line_items_{name}")
    renamed = [F.col(source).alias(target) for target, source in columns.items()]
    return table.select(F.col(LINE_HASH).alias("line_key"), *renamed)


def _json_lines(lines: DataFrame, period: bool, product: bool, interval: bool) -> DataFrame:
    columns: list = ["invoice_id", F.col("id").alias("line_key"), "type", "amount"]
    if product:
        columns.append(jsontext.field(F.col("price"), "product").alias("product"))
    if interval:
        columns.append(jsontext.field(F.col("plan"), "interval").alias("interval"))
    if period:
        lines = lines.withColumn("span", jsontext.epoch_range(F.col("period")))
        columns.append(epoch_timestamp(F.col("span.start")).alias("line_start"))
        columns.append(epoch_timestamp(F.col("span.end")).alias("line_end"))
    if SALT in lines.columns:
        columns.append(SALT)
    rows = lines.select(*columns)
    return rows.filter(F.col("interval").isNotNull()) if interval else rows


def with_lines(t: BillingTables, invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Invoices joined with their `invoice_lines`.

    Lines of salted buckets stay where they are: an invoice whose lines are cut into parts
    is repeated for each part and joined on both, so no task has all of its lines.
    """
    if SALT not in lines.columns:
        return invoices.join(lines, "invoice_id")
    hot = getattr(t, HOT_INVOICES)  # fewer rows than buckets
    parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    repeated = invoices.join(hot, "invoice_id", "left").withColumn(SALT, F.explode(parts)).drop("parts")
    return repeated.join(lines, ["invoice_id", SALT]).drop(SALT)


def first_discounts(t: BillingTables) -> DataFrame:
    """line_key, discount of the JSON layout: one row for each line id that has a discount.

    A line id may be that of several rows, and its discount is the first element of the list
    of any of them. Which row counts is open; here it is the one whose first element is
    smallest, a minimum that every map task takes before the shuffle.
    """
    first = jsontext.first_amount(F.col("discount_amounts"))
    # Most lists are empty; a filter on the amount itself would be a second parse.
    listed = t.invoice_line_items.filter(F.col("id").isNotNull() & (F.col("discount_amounts") != "[]"))
    return listed.groupBy(F.col("id").alias("line_key")).agg(F.min(first).alias("discount"))


def with_first_discount(t: BillingTables, lines: DataFrame) -> DataFrame:
    """Add the discount of each line's id; a line without one, or without an id, has NULL.

    The right side has one row per id, so a hot id multiplies nothing and its lines can be
    split by adaptive execution.
    """
    return lines.join(first_discounts(t), "line_key", "left")


def with_product(t: BillingTables, lines: DataFrame, how: str = "inner") -> DataFrame:
    """Add product_name of the line's product."""
    products = t.products.select(F.col("id").alias("product"), F.col("name").alias("product_name"))
    return lines.join(products, "product", how)


def with_product_prices(t: BillingTables, lines: DataFrame, how: str = "inner") -> DataFrame:
    """Add product_name and price_cents: one row per price of the line's product.

    A price is found through the product, so a line of an unknown product has no price.
    """
    prices = t.prices.select(
        F.col("product").alias("priced_product"), F.col("unit_amount").alias("price_cents")
    )
    products = t.products.select(F.col("id").alias("product"), F.col("name").alias("product_name"))
    # One after the other: the planner judges the size of each table by itself.
    named = lines.join(products.withColumn("known_product", F.col("product")), "product", how)
    priced = F.col("known_product") == F.col("priced_product")
    return named.join(prices, priced, how).drop("known_product", "priced_product")
