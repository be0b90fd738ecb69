"""Customer movements between neighbouring periods, and their monthly sums."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtally.functions.dates import clock
from subtally.operators.grouping import first_per_group
from subtally.operators.periods import PAID, PAYMENT_FAILED, is_billable, with_month_keys

# Stand-ins for a missing neighbour; fixed values.
NO_PREVIOUS = -111
NO_NEXT = -222

AsOf = dt.datetime | Column | None


def with_neighbours(keyed: DataFrame, group: Sequence[str] = ("customer",)) -> DataFrame:
    """Amounts of the previous and next period of the same customer.

    A customer has at most one kept invoice per month and its periods are distinct, so
    the group is bounded by calendar and price list, not by the number of invoices.
    """
    net = "total" in keyed.columns
    order = ["start_year", "start_month", "subscription_end", "unit_amount"]
    order += [name for name in ("total", "reason") if name in keyed.columns]
    window = Window.partitionBy(*group).orderBy(*[F.asc_nulls_last(name) for name in order])

    def before(name: str) -> Column:
        return F.coalesce(F.lag(name).over(window), F.lit(NO_PREVIOUS))

    def after(name: str) -> Column:
        return F.coalesce(F.lead(name).over(window), F.lit(NO_NEXT))

    columns = {"previous_subtotal": before("unit_amount"), "next_subtotal": after("unit_amount")}
    if net:
        columns |= {"previous_total": before("total"), "next_total": after("total")}
    return keyed.withColumns(columns)


def is_upgrade() -> Column:
    previous = F.col("previous_subtotal")
    return (F.col("unit_amount") > previous) & ~previous.isin(NO_PREVIOUS, 0)


def is_downgrade() -> Column:
    now = F.col("unit_amount")
    return (now < F.col("previous_subtotal")) & (now != 0)


def is_reactivation() -> Column:
    return (F.col("unit_amount") > 0) & (F.col("previous_subtotal") == 0)


def churn_code(as_of: AsOf, ended_only: bool = True) -> Column:
    """1: moved to free. 2: last paid period, not of the current month. Otherwise 0.

    With `ended_only` code 2 also asks that the period has ended.
    """
    now = clock(as_of)
    amount = F.col("unit_amount")
    last_paid = (F.col("next_subtotal") < 0) & (amount > 0)
    current = (F.col("start_year") == F.year(now)) & (F.col("start_month") == F.month(now))
    lapsed = last_paid & ~current
    if ended_only:
        lapsed = lapsed & (now > F.col("subscription_end").cast("timestamp"))
    return (
        F.when((F.col("previous_subtotal") > 0) & (amount == 0), 1).when(lapsed, 2).otherwise(0)
    )


def _known_customer() -> Column:
    """What one row adds to a count of customers."""
    return F.col("customer").isNotNull().cast("long")


def _measures(net: bool) -> dict[str, Column]:
    """What a flagged row adds to each movement."""
    if net:
        change = F.col("total") - F.col("previous_total")
        return {
            "new": F.col("total"),
            "moved_to_free": F.col("previous_total"),
            "lapsed": F.col("total"),
            "upgrade": change,
            "downgrade": change,
            "reactivation": F.col("total"),
        }
    known, one = _known_customer(), F.lit(1).cast("long")
    return {
        "new": known,
        "moved_to_free": known,
        "lapsed": known,
        "upgrade": one,
        "downgrade": one,
        "reactivation": known,
    }


FLAGS = {
    "upgrade": is_upgrade,
    "downgrade": is_downgrade,
    "reactivation": is_reactivation,
}


def movement_by_month(neighbours: DataFrame, movement: str, alias: str) -> DataFrame:
    """One movement by start month: a count, or a sum of money when totals are carried."""
    measure = _measures("total" in neighbours.columns)[movement]
    return (
        neighbours.filter(FLAGS[movement]())
        .groupBy("start_month", "start_year")
        .agg(F.sum(measure).alias(alias))
    )


def churn_sums(coded: DataFrame) -> DataFrame:
    """Code 1 by start month and code 2 by end month, with the number of rows of each.

    A row has one code, so it belongs to one month and both codes fit in one grouping.
    """
    measures = _measures("total" in coded.columns)
    code = F.col("churn")
    free, lapsed = code == 1, code == 2
    months = coded.filter(code != 0).select(
        F.when(free, F.col("start_month")).otherwise(F.col("end_month")).alias("month"),
        F.when(free, F.col("start_year")).otherwise(F.col("end_year")).alias("year"),
        F.when(free, measures["moved_to_free"]).alias("moved_to_free"),
        F.when(lapsed, measures["lapsed"]).alias("lapsed"),
    )
    return months.groupBy("month", "year").agg(
        F.sum("moved_to_free").alias("moved_to_free"),
        F.sum("lapsed").alias("lapsed"),
        F.count("moved_to_free").alias("moves"),
        F.count("lapsed").alias("lapses"),
    )


def churn_by_month(coded: DataFrame, alias: str) -> DataFrame:
    """Both codes added up by month; months without code 1 are left out."""
    return (
        churn_sums(coded)
        .filter("moves > 0")
        .select(
            F.col("month").alias("start_month"),
            F.col("year").alias("start_year"),
            _churn_total("total" in coded.columns).alias(alias),
        )
    )


def _churn_total(net: bool) -> Column:
    churned = F.col("moved_to_free") + F.coalesce(F.col("lapsed"), F.lit(0))
    return F.lit(-1) * churned if net else churned


def is_payable() -> Column:
    return (F.col("status") == PAID) & (F.col("unit_amount") > 0)


def _start_order(periods: DataFrame) -> list[Column]:
    names = ["subscription_start", "subscription_end", "unit_amount"]
    names += ["total"] if "total" in periods.columns else []
    return [F.asc_nulls_last(name) for name in names]


def first_paid_period(periods: DataFrame) -> DataFrame:
    """The earliest period with a price above zero per customer."""
    return first_per_group(
        periods.filter(is_payable()), ["customer"], _start_order(periods)
    ).withColumns({"year": F.year("subscription_start"), "month": F.month("subscription_start")})


def new_customers_by_month(first: DataFrame, alias: str) -> DataFrame:
    """First paid periods by month: a count, or a sum of money when totals are carried."""
    measure = _measures("total" in first.columns)["new"]
    return first.groupBy("month", "year").agg(F.sum(measure).alias(alias))


def all_movements_by_month(periods: DataFrame, as_of: AsOf) -> DataFrame:
    """Every movement of the periods by month, for months that have a new customer.

    The periods come partitioned by customer, which serves the neighbour windows and the
    first paid period alike; one grouping by month serves all movements. Columns: year,
    month, new, voluntary_churn, upgrade, downgrade, reactivation.
    """
    net = "total" in periods.columns
    by_customer = with_month_keys(periods).withColumns(
        {
            "billable": F.coalesce(is_billable(), F.lit(False)),
            "payable": F.coalesce(is_payable(), F.lit(False)),
        }
    )
    compared = with_neighbours(by_customer, ("customer", "billable"))
    earliest = Window.partitionBy("customer", "payable").orderBy(*_start_order(periods))
    ranked = compared.withColumn("start_rank", F.row_number().over(earliest))

    billable = F.col("billable")
    eligible = billable & (F.col("reason") != PAYMENT_FAILED)
    flags = {
        "new": F.col("payable") & (F.col("start_rank") == 1),
        "moved_to_free": eligible & (F.col("churn") == 1),
        "upgrade": billable & is_upgrade(),
        "downgrade": billable & is_downgrade(),
        "reactivation": billable & is_reactivation(),
    }
    measures = _measures(net)
    value_type = "double" if net else "long"
    at_start = F.struct(
        F.col("start_year").alias("year"),
        F.col("start_month").alias("month"),
        *[F.when(flag, measures[name]).alias(name) for name, flag in flags.items()],
        F.lit(None).cast(value_type).alias("lapsed"),
    )
    at_end = F.struct(
        F.col("end_year").alias("year"),
        F.col("end_month").alias("month"),
        *[F.lit(None).cast(value_type).alias(name) for name in flags],
        measures["lapsed"].alias("lapsed"),
    )
    lapsed = eligible & (F.col("churn") == 2)
    events = ranked.withColumn("churn", churn_code(as_of)).select(
        F.inline(F.when(lapsed, F.array(at_start, at_end)).otherwise(F.array(at_start)))
    )
    sums = events.groupBy("year", "month").agg(
        *[F.sum(name).alias(name) for name in (*flags, "lapsed")],
        F.count("new").alias("arrivals"),
        F.count("moved_to_free").alias("moves"),
    )
    churn = F.when(F.col("moves") > 0, _churn_total(net))
    zero = F.lit(0)
    return sums.filter("arrivals > 0").select(
        "year",
        "month",
        "new",
        F.coalesce(churn, zero).alias("voluntary_churn"),
        *[F.coalesce(F.col(name), zero).alias(name) for name in FLAGS],
    )
