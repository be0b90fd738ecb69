"""Monthly recurring revenue by movement, for both layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.operators.delinquency import delinquent_by_month
from subtally.operators.movements import (
    AsOf,
    all_movements_by_month,
    churn_by_month,
    churn_code,
    first_paid_period,
    movement_by_month,
    new_customers_by_month,
    with_neighbours,
)
from subtally.operators.periods import customer_periods, period_keys
from subtally.plans.months import by_month, month_order
from subtally.sources.tables import BillingTables


def new_customer_mrr(t: BillingTables) -> DataFrame:
    """month, year, new_customer_mrr of each customer's first paid period."""
    first = first_paid_period(customer_periods(t, net=True))
    return by_month(new_customers_by_month(first, "new_customer_mrr"), "year", "month")


def _movement_mrr(t: BillingTables, movement: str) -> DataFrame:
    neighbours = with_neighbours(period_keys(customer_periods(t, net=True)))
    return by_month(movement_by_month(neighbours, movement, "sum"), "start_year", "start_month")


def upgrade_mrr(t: BillingTables) -> DataFrame:
    """start_month, start_year, sum of the change of total on price rises."""
    return _movement_mrr(t, "upgrade")


def downgrade_mrr(t: BillingTables) -> DataFrame:
    """start_month, start_year, sum of the change of total on price cuts."""
    return _movement_mrr(t, "downgrade")


def reactivation_mrr(t: BillingTables) -> DataFrame:
    """start_month, start_year, sum of the totals that follow a free period."""
    return _movement_mrr(t, "reactivation")


def voluntary_churn_mrr(t: BillingTables, as_of: AsOf = None) -> DataFrame:
    """start_month, start_year, voluntary_churn_mrr as a negative amount."""
    periods = customer_periods(t, cancel=True, net=True, drop_failed=True)
    coded = with_neighbours(period_keys(periods)).withColumn("churn", churn_code(as_of))
    return churn_by_month(coded, "voluntary_churn_mrr")


def delinquent_mrr(t: BillingTables) -> DataFrame:
    """month, year, delinquent_mrr as a positive amount."""
    return by_month(delinquent_by_month(t, "delinquent_mrr", net=True), "year", "month")


def mrr_movements(t: BillingTables, as_of: AsOf = None) -> DataFrame:
    """Six movements of the months with a new customer, and their sum."""
    periods = customer_periods(t, reason=True, cancel=True, net=True)
    months = all_movements_by_month(periods, as_of).join(
        delinquent_by_month(t, "lost", net=True), ["year", "month"], "left"
    )
    named = months.select(
        "year",
        "month",
        F.col("new").alias("new_customer_mrr"),
        F.col("voluntary_churn").alias("voluntary_churn_mrr"),
        F.col("upgrade").alias("upgrade_mrr"),
        F.col("downgrade").alias("downgrade_mrr"),
        F.col("reactivation").alias("reactivated_mrr"),
        F.coalesce("lost", F.lit(0.0)).alias("delinquent_mrr"),
    )
    change = sum((F.col(name) for name in named.columns[3:]), F.col("new_customer_mrr"))
    return named.withColumn("summed_metrics", change)


def existing_mrr(t: BillingTables, as_of: AsOf = None) -> DataFrame:
    """Six movements of the months with a new customer, and the running sum."""
    months = mrr_movements(t, as_of)
    running = F.sum("summed_metrics").over(month_order())
    total = F.coalesce(running, F.lit(0.0))
    result = months.withColumn("existing_mrr", total).drop("summed_metrics")
    return by_month(result, "year", "month")
