"""Average revenue per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.functions.dates import MONTHS_IN_YEAR, epoch_timestamp, month_label, month_starts
from subtally.functions.money import fractional_units, whole_units
from subtally.operators.grouping import not_in
from subtally.operators.lines import invoice_lines, with_lines, with_product_prices
from subtally.operators.periods import YEAR
from subtally.sources.tables import BillingTables

REVENUE_COLUMNS = (
    "id",
    "customer",
    "customer_email",
    "subscription",
    "paid",
    "status",
    "name",
    "unit_amount",
    "amount",
    "usage_start",
    "usage_end",
    "subscription_start",
    "subscription_end",
)


def unrefunded_lines(t: BillingTables) -> DataFrame:
    """Priced lines of invoices whose charge was not refunded.

    Without a charge, or with one unknown refund, nothing can be said to be unrefunded:
    the row, or every row, is left out.
    """
    invoices = not_in(t.invoices, "charge", t.refunds.select("charge")).select(
        F.col("id").alias("invoice_id"),
        "customer",
        "customer_email",
        "subscription",
        "paid",
        "status",
        "total_excluding_tax",
        "period_start",
        "period_end",
    )
    lines = invoice_lines(t, kind=None, product="price", interval=True).drop("amount")
    return with_product_prices(t, with_lines(t, invoices, lines))


def spread_revenue(lines: DataFrame) -> DataFrame:
    """Yearly lines as twelve monthly rows of a twelfth, others as one row.

    Yearly amounts are fractions, the others whole units cut toward zero. Only the start
    of a yearly row moves from month to month; its end stays the line's.
    """
    yearly = F.col("interval") == YEAR
    day = F.to_date("line_start")
    months = month_starts(day).cast("array<timestamp>")
    starts = F.when(yearly & day.isNotNull(), months).when(~yearly, F.array("line_start"))

    def units(cents: str):
        share = fractional_units(F.col(cents)) / F.lit(float(MONTHS_IN_YEAR))
        return F.when(yearly, share).otherwise(whole_units(cents).cast("double"))

    return lines.select(
        F.col("invoice_id").alias("id"),
        "customer",
        "customer_email",
        "subscription",
        "paid",
        "status",
        F.col("product_name").alias("name"),
        units("price_cents").alias("unit_amount"),
        units("total_excluding_tax").alias("amount"),
        epoch_timestamp(F.col("period_start")).alias("usage_start"),
        epoch_timestamp(F.col("period_end")).alias("usage_end"),
        F.explode(starts).alias("subscription_start"),
        F.col("line_end").alias("subscription_end"),
        "interval",
    )


def revenue_monthly(t: BillingTables) -> DataFrame:
    """Distinct invoice rows per month, the columns of `REVENUE_COLUMNS`."""
    return spread_revenue(unrefunded_lines(t)).select(*REVENUE_COLUMNS).distinct()


def revenue_by_month(revenue: DataFrame) -> DataFrame:
    """month_name, year, total_revenue, total_customers."""
    return revenue.groupBy(
        month_label(F.col("subscription_start")).alias("month_name"),
        F.year("subscription_start").alias("year"),
    ).agg(
        F.sum("amount").alias("total_revenue"),
        F.countDistinct("customer").alias("total_customers"),
    )


def arpu_monthly(t: BillingTables) -> DataFrame:
    """month_name, year, arpu_monthly: revenue over distinct customers."""
    months = revenue_by_month(revenue_monthly(t))
    average = F.col("total_revenue") / F.col("total_customers")
    return months.select("month_name", "year", average.alias("arpu_monthly"))
