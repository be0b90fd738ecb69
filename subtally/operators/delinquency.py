"""Customers lost because their payment failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.functions.dates import epoch_timestamp
from subtally.functions.money import net_units
from subtally.operators.grouping import may_be_in
from subtally.operators.lines import (
    invoice_lines,
    with_first_discount,
    with_lines,
    with_product_prices,
)
from subtally.operators.periods import PAYMENT_FAILED, reasoned_subscriptions
from subtally.sources.tables import BillingTables


def cancelled(t: BillingTables, subscriptions: DataFrame) -> DataFrame:
    """Those subscriptions whose id occurs with a cancel date."""
    dated = t.subscriptions.filter(
        F.col("cancel_at").isNotNull() | F.col("canceled_at").isNotNull()
    ).select("id")
    return subscriptions.join(dated, "id", "left_semi")


def failed_subscriptions(t: BillingTables) -> DataFrame:
    """Subscriptions with a cancel date whose payment failed."""
    reasoned = reasoned_subscriptions(t, "inner").filter(F.col("reason") == PAYMENT_FAILED)
    return cancelled(
        t, reasoned.select("id", "customer", "latest_invoice", "status", "reason", "cancel_at", "canceled_at")
    )


def failed_payments(
    t: BillingTables, net: bool = False, subscriptions: DataFrame | None = None
) -> DataFrame:
    """Lines of the latest invoice of each subscription cancelled for a failed payment.

    All line types and invoice states; one row per price of the line's product and, in
    the normalized layout with `net`, per discount. `total` is the net line amount.
    `subscriptions` are the failed ones, where the caller has them already.
    """
    subscriptions = failed_subscriptions(t) if subscriptions is None else subscriptions
    failed = subscriptions.withColumnRenamed("latest_invoice", "invoice_id")
    invoices = t.invoices.select(F.col("id").alias("invoice_id"))
    lines = may_be_in(
        invoice_lines(t, kind=None, product="price", discount=net), "invoice_id", failed.select("invoice_id")
    )
    rows = with_lines(t, failed.join(invoices, "invoice_id"), lines)
    if net and t.is_json:
        rows = with_first_discount(t, rows)
    priced = with_product_prices(t, rows)
    columns = ["id", "customer", "status", "type", "reason", "invoice_id", "product_name", "price_cents"]
    total = [net_units(F.col("amount"), F.col("discount")).alias("total")] if net else []
    return priced.select(
        *columns,
        epoch_timestamp(F.col("cancel_at")).alias("cancel_at"),
        epoch_timestamp(F.col("canceled_at")).alias("cancelled_at"),
        "line_start",
        "line_end",
        F.month("line_start").alias("month"),
        F.year("line_start").alias("year"),
        *total,
    )


def invoice_months(t: BillingTables, customers: DataFrame) -> DataFrame:
    """customer, year, month of every invoice line of the listed customers.

    Paid or not, for known subscriptions only; a month repeats with its lines.
    """
    invoices = t.invoices.join(customers, "customer", "left_semi").select(
        F.col("id").alias("invoice_id"), "customer", "subscription"
    )
    known = t.subscriptions.select(F.col("id").alias("subscription"))
    invoices = invoices.join(known, "subscription", "left_semi")
    lines = invoice_lines(t, kind=None)
    return (
        with_lines(t, invoices, lines)
        .select("customer", F.year("line_start").alias("year"), F.month("line_start").alias("month"))
    )


def months_per_customer(months: DataFrame) -> DataFrame:
    """Number of distinct invoice months per customer."""
    return months.distinct().groupBy("customer").agg(F.count("customer").alias("customer_count"))


def repeat_customers(months: DataFrame) -> DataFrame:
    """Customers with more than one month.

    More than one month means that the first differs from the last, so two integers per
    customer are enough and every map task combines its rows before the shuffle.
    """
    number = F.coalesce(F.col("year") * 12 + F.col("month"), F.lit(-1))
    return (
        months.filter(F.col("customer").isNotNull())
        .groupBy("customer")
        .agg(F.min(number).alias("first"), F.max(number).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("customer")
    )


def delinquent_by_month(t: BillingTables, alias: str, net: bool = False) -> DataFrame:
    """Distinct customers, or the sum of net line amounts, by month of the failed line."""
    # Customers of failed subscriptions include all of `failed_payments` and cost no
    # join with invoices; the final semi join removes the rest.
    subscriptions = failed_subscriptions(t)
    repeated = repeat_customers(invoice_months(t, subscriptions.select("customer")))
    failed = failed_payments(t, net, subscriptions).join(repeated, "customer", "left_semi")
    measure = F.sum("total") if net else F.countDistinct("customer")
    return failed.groupBy("month", "year").agg(measure.alias(alias))
