"""The subscription-based monthly overview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.functions.dates import epoch_timestamp
from subtally.operators.grouping import not_in, with_neighbours
from subtally.operators.lines import invoice_lines, with_lines, with_product, with_product_prices
from subtally.operators.periods import PAYMENT_FAILED
from subtally.plans.months import by_month, month_order
from subtally.sources.schemas import SUBSCRIPTION_HASH
from subtally.sources.tables import BillingTables

LIVE = ("active", "past_due", "incomplete")
# States of a subscription that is live or never started; fixed values.
NOT_ENDED = ("incomplete_expired", "active", "past_due", "incomplete")
REQUESTED = "cancellation_requested"


def invoiced_lines(t: BillingTables) -> DataFrame:
    """Every invoice line with its product, one row per price, and its period."""
    invoices = t.invoices.select(
        F.col("id").alias("invoice_id"),
        "customer",
        "customer_email",
        "subscription",
        "paid",
        F.col("status").alias("invoice_status"),
        epoch_timestamp(F.col("period_start")).alias("usage_start"),
        epoch_timestamp(F.col("period_end")).alias("usage_end"),
    )
    lines = invoice_lines(t, kind=None, product="price")
    priced = with_product_prices(t, with_lines(t, invoices, lines))
    return priced.select(
        "invoice_id",
        "line_key",
        "customer",
        "customer_email",
        "subscription",
        "paid",
        "invoice_status",
        "product_name",
        F.col("price_cents").alias("subscription_price"),
        "usage_start",
        "usage_end",
        F.col("line_start").alias("subscription_start"),
        F.col("line_end").alias("subscription_end"),
    )


def live_subscriptions(t: BillingTables) -> DataFrame:
    """Live subscriptions with a period, one row per plan."""
    plans = t.subscriptions_plan.select(
        SUBSCRIPTION_HASH,
        F.col("interval").alias("plan_interval"),
        F.col("nickname").alias("plan_nickname"),
        F.col("amount").alias("plan_amount"),
    )
    begins, ends = F.col("current_period_start"), F.col("current_period_end")
    return (
        t.subscriptions.filter(F.col("status").isin(*LIVE) & (begins != ends))
        .join(plans, SUBSCRIPTION_HASH)
        .select(
            F.col("id").alias("subscription_id"),
            F.col("customer").alias("subscription_customer"),
            F.col("latest_invoice").alias("invoice_id"),
            F.col("status").alias("subscription_status"),
            "plan_interval",
            "plan_nickname",
            "plan_amount",
            epoch_timestamp(begins).alias("subscription_period_start"),
            epoch_timestamp(ends).alias("subscription_period_end"),
        )
    )


def paid_history(t: BillingTables) -> DataFrame:
    """Paid lines with the live subscription whose latest invoice they belong to, if any."""
    paid = invoiced_lines(t).filter(F.col("paid").eqNullSafe(True))
    return paid.join(live_subscriptions(t), "invoice_id", "left")


def price_changes(history: DataFrame) -> DataFrame:
    """Next price and date and previous subscription id along each customer's lines.

    A customer's lines are not bounded by anything, hence neighbours across pieces.
    """
    names = ["subscription_start", "invoice_id", "line_key", "subscription_price"]
    return with_neighbours(
        history.select("customer", "subscription", *names),
        key="customer",
        order=names,
        lags={"prev_subscription": "subscription"},
        leads={
            "next_subscription_price": "subscription_price",
            "next_subscription_date": "subscription_start",
        },
    )


def changes_by_month(changes: DataFrame) -> DataFrame:
    """year, month, new_customer, upgrades, downgrades, for months with a line.

    A row counts as new in the month of its start and as upgrade or downgrade in the
    month of the next line; both go through one grouping. Months that are nobody's next
    have NULL upgrades and downgrades.
    """
    now, following = F.col("subscription_price"), F.col("next_subscription_price")
    one = F.lit(1).cast("long")
    nothing = F.lit(None).cast("long")
    start = F.struct(
        F.year("subscription_start").alias("year"),
        F.month("subscription_start").alias("month"),
        F.col("prev_subscription").isNull().cast("long").alias("new_customer"),
        nothing.alias("upgrades"),
        nothing.alias("downgrades"),
    )
    upcoming = F.struct(
        F.year("next_subscription_date").alias("year"),
        F.month("next_subscription_date").alias("month"),
        nothing.alias("new_customer"),
        F.when(following > now, one).otherwise(0).alias("upgrades"),
        F.when(following < now, one).otherwise(0).alias("downgrades"),
    )
    dated = F.col("next_subscription_date").isNotNull()
    events = changes.select(
        F.inline(F.when(dated, F.array(start, upcoming)).otherwise(F.array(start)))
    )
    measures = ["new_customer", "upgrades", "downgrades"]
    sums = events.groupBy("year", "month").agg(*[F.sum(name).alias(name) for name in measures])
    return sums.filter(F.col("new_customer").isNotNull())


def with_cumulative_new(months: DataFrame) -> DataFrame:
    """Running sum of new customers; an unknown month has none."""
    known = F.col("year").isNotNull() & F.col("month").isNotNull()
    total = F.sum("new_customer").over(month_order())
    return months.withColumn("cumulative_new_customers", F.when(known, total))


def ended_subscriptions(t: BillingTables) -> DataFrame:
    """Lines of the latest invoice of ended subscriptions, with the reason."""
    reasons = t.subscriptions_cancellation_details.select(SUBSCRIPTION_HASH, "reason")
    ended = (
        t.subscriptions.filter(~F.col("status").isin(*NOT_ENDED))
        .join(reasons, SUBSCRIPTION_HASH, "left")
        .select(
            F.col("id").alias("subscription_id"),
            F.col("latest_invoice").alias("invoice_id"),
            F.col("status").alias("subscription_status"),
            "cancel_at_period_end",
            "reason",
        )
    )
    invoices = t.invoices.select(
        F.col("id").alias("invoice_id"),
        "customer",
        F.col("status").alias("invoice_status"),
        "billing_reason",
        "attempt_count",
        F.col("paid").alias("invoice_paid"),
    )
    lines = invoice_lines(
        t, kind=None, product="price", how="left", invoice_column="invoice", only=ended.select("invoice_id")
    )
    rows = invoices.join(ended, "invoice_id").join(lines, "invoice_id", "left")
    return with_product(t, rows, "left").select(
        "invoice_id",
        "customer",
        "subscription_id",
        "invoice_status",
        "subscription_status",
        "product_name",
        "reason",
        "billing_reason",
        "cancel_at_period_end",
        "attempt_count",
        "invoice_paid",
        F.col("line_start").alias("subscription_start"),
        F.col("line_end").alias("subscription_end"),
    )


def churned(t: BillingTables, ended: DataFrame) -> DataFrame:
    """Ended subscriptions, requested or failed, of customers with no live one."""
    live = t.subscriptions.filter(F.col("status").isin(*LIVE)).select("customer")
    return not_in(ended.filter(F.col("reason").isin(REQUESTED, PAYMENT_FAILED)), "customer", live)


def churn_by_start_month(rows: DataFrame) -> DataFrame:
    """Churned rows of either reason by month of start."""
    def lost(reason: str):
        return F.count(F.when(F.col("reason") == reason, 1))

    return rows.groupBy(
        F.year("subscription_start").alias("year"), F.month("subscription_start").alias("month")
    ).agg(lost(REQUESTED).alias("voluntary"), lost(PAYMENT_FAILED).alias("involuntary"))


def customer_analytics(t: BillingTables) -> DataFrame:
    """New, upgraded, downgraded, existing and churned customers by month.

    `existing_customers` is the running number of new customers less the churn of the
    month itself, not of earlier months.
    """
    months = with_cumulative_new(changes_by_month(price_changes(paid_history(t))))
    churn = churn_by_start_month(churned(t, ended_subscriptions(t)))
    voluntary = F.coalesce("voluntary", F.lit(0))
    involuntary = F.coalesce("involuntary", F.lit(0))
    result = months.join(churn, ["year", "month"], "left").select(
        "year",
        "month",
        "new_customer",
        "upgrades",
        "downgrades",
        (F.col("cumulative_new_customers") - (voluntary + involuntary)).alias("existing_customers"),
        voluntary.alias("voluntary_churned_customer"),
        involuntary.alias("involuntary_churned_customer"),
    )
    return by_month(result, "year", "month")
