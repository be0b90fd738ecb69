"""The metrics by survey id, over billing tables derived from a star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from subtally import steps
from subtally.plans import analytics, arpu, counts, mrr, receivables
from subtally.session import utc
from subtally.sources.schemas import Layout
from subtally.sources.star import billing_tables
from subtally.sources.tables import BillingTables

AS_OF = dt.datetime(2001, 6, 15, tzinfo=dt.timezone.utc)

Step = Callable[[BillingTables], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]
Source = Callable[[SparkSession, str, Layout], BillingTables]


def _days_as_timestamps(frame: DataFrame) -> DataFrame:
    """Dates as midnight timestamps, which every client's data frame holds alike."""
    days = [f.name for f in frame.schema.fields if isinstance(f.dataType, DateType)]
    return frame.withColumns({name: F.col(name).cast("timestamp") for name in days})


def over_star(step: Step, layout: Layout = "normalized", source: Source = billing_tables) -> Query:
    """A query over the star tables in a folder, in UTC; the session keeps its settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with utc(spark):
            return _days_as_timestamps(step(source(spark, sf_dir, layout)))

    return run


def _rounded_arpu(t: BillingTables) -> DataFrame:
    """Sums of fractions differ in the last digits from one engine to the next."""
    return arpu.arpu_monthly(t).withColumn("arpu_monthly", F.round("arpu_monthly", 6))


ROOT_METRICS: dict[str, Step] = {
    "Q01": _rounded_arpu,
    "Q02": arpu.revenue_monthly,
    "Q03": lambda t: counts.voluntary_churn_left(t, AS_OF),
    "Q04": analytics.customer_analytics,
    "Q05": receivables.pending_payments,
    "Q06": receivables.cancelled_subscriptions,
}

# In order Q07-Q20 for the normalized and Q21-Q34 for the JSON layout.
LAYOUT_METRICS: tuple[Step, ...] = (
    counts.new_customer_count,
    counts.upgrades,
    counts.downgrades,
    counts.reactivations,
    lambda t: counts.voluntary_churn(t, AS_OF),
    counts.delinquent_churn,
    lambda t: counts.existing_customers(t, AS_OF),
    mrr.new_customer_mrr,
    mrr.upgrade_mrr,
    mrr.downgrade_mrr,
    mrr.reactivation_mrr,
    lambda t: mrr.voluntary_churn_mrr(t, AS_OF),
    mrr.delinquent_mrr,
    lambda t: mrr.existing_mrr(t, AS_OF),
)


def metric_queries(source: Source = billing_tables) -> dict[str, Query]:
    """Q01-Q34 by id."""
    queries = {key: over_star(step, source=source) for key, step in ROOT_METRICS.items()}
    for layout, first in (("normalized", 7), ("json", 21)):
        queries |= {
            f"Q{first + i:02d}": over_star(step, layout, source)
            for i, step in enumerate(LAYOUT_METRICS)
        }
    return queries


def step_queries() -> dict[str, Query]:
    """P and C steps and the table scan by id."""
    return {key: over_star(step, layout) for key, (step, layout) in steps.step_queries(AS_OF).items()}
