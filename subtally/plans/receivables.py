"""Pending payments and cancelled subscriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.functions.dates import epoch_date
from subtally.operators.delinquency import cancelled
from subtally.operators.grouping import first_per_group
from subtally.operators.lines import invoice_lines, with_lines, with_product
from subtally.operators.periods import PAID, reasoned_subscriptions
from subtally.sources.tables import BillingTables


def latest_entries(t: BillingTables) -> DataFrame:
    """The latest invoice line per customer with its payment intent; latest_entry is 1."""
    invoices = t.invoices.select(
        F.col("id").alias("invoice_id"),
        "customer",
        "total",
        F.col("status").alias("i_status"),
        "billing_reason",
        epoch_date(F.col("period_start")).alias("usage_start"),
        epoch_date(F.col("period_end")).alias("usage_end"),
        "payment_intent",
    )
    intents = t.payment_intents.select(
        F.col("invoice").alias("invoice_id"), F.col("status").alias("pi_status")
    )
    lines = invoice_lines(t, kind=None, period=False, product="price").drop("amount")
    rows = with_product(t, with_lines(t, invoices.join(intents, "invoice_id"), lines))
    ties = ["invoice_id", "line_key", "product_name", "pi_status"]
    return first_per_group(
        rows,
        ["customer"],
        [F.desc_nulls_first("usage_start"), *[F.asc_nulls_last(name) for name in ties]],
        rank="latest_entry",
    ).select(
        "latest_entry",
        "customer",
        "total",
        "i_status",
        "pi_status",
        "billing_reason",
        F.col("product_name").alias("name"),
        "usage_start",
        "usage_end",
        "invoice_id",
        "payment_intent",
    )


def pending_payments(t: BillingTables) -> DataFrame:
    """Latest entries that are neither paid nor settled nor a first invoice."""
    return latest_entries(t).filter(
        (F.col("i_status") != PAID)
        & (F.col("pi_status") != "succeeded")
        & (F.col("billing_reason") != "subscription_create")
    )


def cancelled_subscriptions(t: BillingTables) -> DataFrame:
    """id, status, reason, customer, latest_invoice, cancel_at, cancelled_at."""
    return cancelled(t, reasoned_subscriptions(t, "inner")).select(
        "id",
        "status",
        "reason",
        "customer",
        "latest_invoice",
        epoch_date(F.col("cancel_at")).alias("cancel_at"),
        epoch_date(F.col("canceled_at")).alias("cancelled_at"),
    )
