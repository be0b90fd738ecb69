"""From paid invoices to the monthly billing periods of each customer."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.functions import jsontext
from subtally.functions.dates import month_starts
from subtally.functions.money import monthly_share, net_units, whole_units
from subtally.operators.grouping import dealt, first_per_group
from subtally.operators.lines import (
    invoice_lines,
    with_first_discount,
    with_lines,
    with_product_prices,
)
from subtally.sources.schemas import SALT, SUBSCRIPTION_HASH
from subtally.sources.tables import BillingTables

PAID = "paid"
YEAR = "year"
NOT_CANCELLED = "not_cancelled"
PAYMENT_FAILED = "payment_failed"

PeriodFrom = Literal["line", "kept"]


def reasoned_subscriptions(t: BillingTables, how: str = "left") -> DataFrame:
    """Subscriptions with the reason of their cancellation."""
    if t.is_json:
        reason = jsontext.field(F.col("cancellation_details"), "reason")
        frame = t.subscriptions.withColumn("reason", reason)
        return frame if how == "left" else frame.filter(F.col("reason").isNotNull())
    details = t.subscriptions_cancellation_details.select(SUBSCRIPTION_HASH, "reason")
    return t.subscriptions.join(details, SUBSCRIPTION_HASH, how)


def _cancellations(t: BillingTables, with_reason: bool) -> DataFrame:
    source = reasoned_subscriptions(t) if with_reason else t.subscriptions
    return source.select(
        F.col("id").alias("subscription"),
        F.timestamp_seconds("canceled_at").alias("canceled_date"),
        *(
            [F.coalesce("reason", F.lit(NOT_CANCELLED)).alias("reason")]
            if with_reason
            else []
        ),
    )


def keep_invoice(
    t: BillingTables,
    reason: bool = False,
    cancel: bool = False,
    net: bool = False,
    drop_failed: bool = False,
    how: str = "inner",
) -> DataFrame:
    """The paid subscription invoice with the latest line start per customer and month.

    `cancel` joins the subscription for its cancel date, `reason` also for the reason,
    `net` adds the line amount less discount as `total`. `drop_failed` removes winners
    whose subscription failed on payment, after the choice was made. `how="left"` keeps
    invoices of unknown subscriptions and lines without a period.

    Equal starts are decided by invoice, line and line end. The line end decides only among
    JSON lines of one id; it makes this read of the periods the same as the one in
    `billed_lines`, so that both share one shuffle of them. A JSON line's discount hangs on
    its id, so it is looked up for the winners alone.
    """
    invoices = t.invoices.filter(F.col("status") == PAID).select(
        F.col("id").alias("invoice_id"), "customer", "customer_email", "subscription"
    )
    # Before the lines, which are many more and would move once more for it.
    if cancel or reason:
        invoices = invoices.join(_cancellations(t, reason), "subscription", how)
    rows = with_lines(t, invoices.drop("subscription"), invoice_lines(t, discount=net, how=how))
    rows = rows.withColumns(
        {"year": F.year("line_start"), "month": F.month("line_start")}
    )
    ties = [
        F.asc_nulls_last(name)
        for name in ("invoice_id", "line_key", "line_end", *["amount", "discount"] * net, "canceled_date", "reason")
        if name in rows.columns
    ]
    kept = first_per_group(
        rows, ["customer", "month", "year"], [F.desc_nulls_first("line_start"), *ties]
    )
    if drop_failed:
        kept = kept.filter(F.col("reason") != PAYMENT_FAILED)
    if net:
        kept = with_first_discount(t, kept) if t.is_json else kept
        kept = kept.withColumn("total", net_units(F.col("amount"), F.col("discount")))
    wanted = ["canceled_date"] * (cancel or reason) + ["reason"] * reason + ["total"] * net
    return kept.select(
        "invoice_id",
        "customer",
        "customer_email",
        F.lit(PAID).alias("status"),
        "year",
        "month",
        F.col("line_start").alias("kept_start"),
        F.col("line_end").alias("kept_end"),
        *wanted,
    )


def billed_lines(
    t: BillingTables, kept: DataFrame, period_from: PeriodFrom, how: str = "inner", distinct: bool = False
) -> DataFrame:
    """All subscription lines of the kept invoices, one row per price, with their period.

    The period is the line's own or the kept line's. Yearly and other plans come out of
    the same joins; `interval` tells them apart. With `distinct`, lines of an invoice that are
    alike become one before they are joined: every map task shrinks an invoice of very many
    lines, and no task holds the joined rows, which are wider, for this.
    """
    carried = [c for c in ("canceled_date", "reason", "total") if c in kept.columns]
    invoices = kept.select(
        "invoice_id", "customer", "customer_email", "status", "kept_start", "kept_end", *carried
    )
    lines = invoice_lines(t, product="price", interval=True, how=how)
    side = "line" if period_from == "line" else "kept"
    days = {"first_day": F.to_date(f"{side}_start"), "last_day": F.to_date(f"{side}_end")}
    if side == "kept":
        invoices = invoices.withColumns(days)
    else:
        lines = lines.withColumns(days)
    if distinct:
        own = ("invoice_id", "product", "interval", *days, SALT)
        lines = lines.select(*[name for name in own if name in lines.columns]).distinct()
    rows = with_lines(t, invoices, lines)
    return with_product_prices(t, rows, how).select(
        "invoice_id",
        "customer",
        "customer_email",
        "status",
        "product_name",
        whole_units("price_cents").alias("unit_amount"),
        "interval",
        *days,
        *carried,
    )


def expand_periods(lines: DataFrame) -> DataFrame:
    """Twelve monthly rows for a yearly line, one row for any other.

    A yearly `total` is divided over the months. A yearly line without a start has no
    months and disappears.
    """
    yearly = F.col("interval") == YEAR
    start = F.col("first_day")
    starts = F.when(yearly & start.isNotNull(), month_starts(start)).when(~yearly, F.array(start))
    columns = {
        "subscription_end": F.when(yearly, F.add_months("subscription_start", 1)).otherwise(
            F.col("last_day")
        )
    }
    if "total" in lines.columns:
        columns["total"] = F.when(yearly, monthly_share(F.col("total"))).otherwise(F.col("total"))
    return (
        lines.withColumn("subscription_start", F.explode(starts))
        .withColumns(columns)
        .drop("first_day", "last_day")
    )


def union_periods(t: BillingTables, lines: DataFrame) -> DataFrame:
    """Distinct periods of billed lines; of which invoice and plan is lost.

    Lines, made distinct per invoice before they were joined, go to their customer
    unexpanded; months, their distinct and every later window stay in that partitioning. One
    task holds all of that for its customers, so the number of tasks follows the invoices:
    each has few distinct lines left.
    """
    by_customer = dealt(lines, "customer", t.invoices)
    return expand_periods(by_customer).drop("invoice_id", "interval").distinct()


def cut_at_cancel(periods: DataFrame) -> DataFrame:
    """Periods that end by the cancel date, compared at midnight; no date keeps all."""
    end = F.col("subscription_end").cast("timestamp")
    return periods.filter(end <= F.coalesce(F.col("canceled_date"), end))


def customer_periods(
    t: BillingTables,
    reason: bool = False,
    cancel: bool = False,
    net: bool = False,
    drop_failed: bool = False,
    how: str = "inner",
    period_from: PeriodFrom | None = None,
) -> DataFrame:
    """Distinct monthly periods per customer, cut at the cancel date when there is one."""
    kept = keep_invoice(t, reason or drop_failed, cancel, net, drop_failed, how)
    if drop_failed and not reason:
        kept = kept.drop("reason")
    source = period_from or ("kept" if t.is_json else "line")
    periods = union_periods(t, billed_lines(t, kept, source, how, distinct=True))
    return cut_at_cancel(periods) if cancel else periods


def is_billable() -> Column:
    """Paid and not empty: the periods whose neighbours are compared."""
    return (F.col("subscription_start") != F.col("subscription_end")) & (F.col("status") == PAID)


def period_keys(periods: DataFrame) -> DataFrame:
    """Billable periods with the year and month of their start and end."""
    return with_month_keys(periods.filter(is_billable()))


def with_month_keys(periods: DataFrame) -> DataFrame:
    """Year and month of the start and of the end."""
    return periods.withColumns(
        {
            "start_year": F.year("subscription_start"),
            "start_month": F.month("subscription_start"),
            "end_year": F.year("subscription_end"),
            "end_month": F.month("subscription_end"),
        }
    )
