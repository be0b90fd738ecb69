"""Monthly customer counts, for both layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.operators.delinquency import delinquent_by_month
from subtally.operators.grouping import first_per_group
from subtally.operators.lines import invoice_lines, with_lines, with_product
from subtally.operators.movements import (
    AsOf,
    all_movements_by_month,
    churn_by_month,
    churn_code,
    movement_by_month,
    new_customers_by_month,
    with_neighbours,
)
from subtally.operators.periods import PAID, customer_periods, period_keys
from subtally.plans.months import by_month, month_order
from subtally.sources.tables import BillingTables


def first_invoices(t: BillingTables) -> DataFrame:
    """Each customer's earliest line of a paid invoice with a subtotal above zero."""
    invoices = t.invoices.filter((F.col("status") == PAID) & (F.col("subtotal") > 0)).select(
        F.col("id").alias("invoice_id"), "customer", "status", "subtotal"
    )
    lines = invoice_lines(t, kind=None, product="plan")
    rows = with_product(t, with_lines(t, invoices, lines))
    dated = rows.withColumns(
        {
            "subscription_start": F.to_date("line_start"),
            "subscription_end": F.to_date("line_end"),
            "year": F.year("line_start"),
            "month": F.month("line_start"),
        }
    )
    order = ["subscription_start", "invoice_id", "line_key", "product_name", "subscription_end"]
    return first_per_group(dated, ["customer"], [F.asc_nulls_last(name) for name in order])


def new_customer_count(t: BillingTables) -> DataFrame:
    """month, year, new_customer_count."""
    counted = new_customers_by_month(first_invoices(t), "new_customer_count")
    return by_month(counted, "year", "month")


def _movement_count(t: BillingTables, movement: str) -> DataFrame:
    neighbours = with_neighbours(period_keys(customer_periods(t)))
    return by_month(
        movement_by_month(neighbours, movement, "count"), "start_year", "start_month"
    )


def upgrades(t: BillingTables) -> DataFrame:
    """start_month, start_year, count of price rises."""
    return _movement_count(t, "upgrade")


def downgrades(t: BillingTables) -> DataFrame:
    """start_month, start_year, count of price cuts to a price above zero."""
    return _movement_count(t, "downgrade")


def reactivations(t: BillingTables) -> DataFrame:
    """start_month, start_year, count of moves from free to paid."""
    return _movement_count(t, "reactivation")


def voluntary_churn(t: BillingTables, as_of: AsOf = None) -> DataFrame:
    """start_month, start_year, voluntary_churn, without failed-payment subscriptions."""
    periods = customer_periods(t, cancel=True, drop_failed=True)
    coded = with_neighbours(period_keys(periods)).withColumn("churn", churn_code(as_of))
    return churn_by_month(coded, "voluntary_churn")


def voluntary_churn_left(t: BillingTables, as_of: AsOf = None) -> DataFrame:
    """start_month, start_year, voluntary_churn over outer joins.

    Unlike `voluntary_churn`, failed payments count, a missing subscription, product or
    price does not exclude a row, and a last paid period need not have ended.
    """
    return _outer_churn(t, as_of)


def _outer_churn(t: BillingTables, as_of: AsOf, how: str = "left") -> DataFrame:
    periods = customer_periods(t, cancel=True, how=how)
    coded = with_neighbours(period_keys(periods)).withColumn(
        "churn", churn_code(as_of, ended_only=False)
    )
    return churn_by_month(coded, "voluntary_churn")


def delinquent_churn(t: BillingTables) -> DataFrame:
    """month, year, count of customers lost to a failed payment."""
    return by_month(delinquent_by_month(t, "count"), "year", "month")


def existing_customers(t: BillingTables, as_of: AsOf = None) -> DataFrame:
    """All movements of the months with a new customer, and the running total."""
    periods = customer_periods(t, reason=True, cancel=True)
    months = all_movements_by_month(periods, as_of).join(
        delinquent_by_month(t, "delinquent"), ["year", "month"], "left"
    )
    lost = F.coalesce("delinquent", F.lit(0))
    change = F.col("new") - F.col("voluntary_churn") + F.col("reactivation") - lost
    return months.select(
        "month",
        "year",
        F.col("new").alias("new_customers"),
        "voluntary_churn",
        F.col("upgrade").alias("upgrades"),
        F.col("downgrade").alias("downgrades"),
        F.col("reactivation").alias("reactivations"),
        lost.alias("delinquent_churn"),
        F.sum(change).over(month_order()).alias("existing_customers"),
    )
