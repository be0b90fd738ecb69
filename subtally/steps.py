"""The pipeline steps (P, C), the table scan and primitives with rules of their own (X) by survey id.

Each entry runs one step of the metrics over whole tables and returns its rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from subtally.functions import jsontext, money
from subtally.functions.dates import epoch_timestamp, month_label
from subtally.operators import delinquency, movements, periods
from subtally.operators.grouping import not_in
from subtally.operators.lines import invoice_lines
from subtally.plans import analytics, arpu, counts, mrr, receivables
from subtally.plans.months import month_order
from subtally.sources.schemas import SCHEMAS, Layout
from subtally.sources.tables import BillingTables

Step = Callable[[BillingTables], DataFrame]

PERIOD_COLUMNS = (
    "customer", "customer_email", "status", "product_name", "unit_amount",
    "canceled_date", "reason", "total", "subscription_start", "subscription_end",
)


def _expanded(t: BillingTables, yearly: bool, how: str = "inner", **flags: bool) -> DataFrame:
    """Period rows of the yearly or of the other lines, before they are made distinct."""
    kept = periods.keep_invoice(t, how=how, **flags)
    source = "kept" if t.is_json else "line"
    rows = periods.expand_periods(periods.billed_lines(t, kept, source, how))
    is_yearly = F.col("interval") == periods.YEAR
    chosen = rows.filter(is_yearly if yearly else ~is_yearly)
    return chosen.select(*[name for name in PERIOD_COLUMNS if name in rows.columns])


def _revenue_rows(t: BillingTables, yearly: bool) -> DataFrame:
    rows = arpu.spread_revenue(arpu.unrefunded_lines(t))
    is_yearly = F.col("interval") == periods.YEAR
    return rows.filter(is_yearly if yearly else ~is_yearly).select(*arpu.REVENUE_COLUMNS)


def _full(t: BillingTables, net: bool = False) -> DataFrame:
    """Periods as the combined metrics use them."""
    return periods.customer_periods(t, reason=True, cancel=True, net=net)


def _neighbours(t: BillingTables, net: bool = False) -> DataFrame:
    keyed = periods.period_keys(_full(t, net))
    return movements.with_neighbours(keyed).drop(
        "customer_email", "status", "product_name", "canceled_date", "subscription_start"
    )


def _coded(t: BillingTables, as_of: dt.datetime, net: bool = False) -> DataFrame:
    return _neighbours(t, net).withColumn("churn", movements.churn_code(as_of))


def _kept_reason(coded: DataFrame) -> DataFrame:
    return coded.filter(F.col("reason") != periods.PAYMENT_FAILED)


def _coded_left(t: BillingTables, as_of: dt.datetime) -> DataFrame:
    keyed = periods.period_keys(periods.customer_periods(t, cancel=True, how="left"))
    coded = movements.with_neighbours(keyed).withColumn(
        "churn", movements.churn_code(as_of, ended_only=False)
    )
    return coded.drop(
        "customer_email", "status", "product_name", "canceled_date", "subscription_start"
    )


def _churn(t: BillingTables, as_of: dt.datetime, rows: str, value: str) -> DataFrame:
    sums = movements.churn_sums(_kept_reason(_coded(t, as_of)))
    return sums.filter(F.col(rows) > 0).select(
        "month", "year", F.col(value).alias("voluntary_churn")
    )


def _flagged(t: BillingTables, name: str) -> DataFrame:
    flag = movements.FLAGS[name]()
    return _neighbours(t, net=True).withColumns(
        {
            name: F.when(flag, 1).otherwise(0),
            "change": F.col("total") - F.col("previous_total"),
        }
    )


def _moved(t: BillingTables, name: str) -> DataFrame:
    return movements.movement_by_month(_neighbours(t), name, "customers")


def _failed_months(t: BillingTables) -> DataFrame:
    return delinquency.invoice_months(t, delinquency.failed_payments(t).select("customer"))


def _first_paid(t: BillingTables) -> DataFrame:
    return movements.first_paid_period(_full(t, net=True)).select(
        "customer", "subscription_start", "subscription_end", "unit_amount", "total", "year", "month"
    )


def _first_invoices(t: BillingTables) -> DataFrame:
    return counts.first_invoices(t).select(
        "customer", "invoice_id", "subtotal", "product_name",
        "subscription_start", "subscription_end", "year", "month",
    )


def _changes(t: BillingTables) -> DataFrame:
    return analytics.price_changes(analytics.paid_history(t))


def _as_text(frame: DataFrame, *names: str) -> DataFrame:
    """Integers that may be NULL as text, which every client prints alike."""
    return frame.withColumns({name: F.col(name).cast("string") for name in names})


def _churned(t: BillingTables, reason: str) -> DataFrame:
    rows = analytics.churned(t, analytics.ended_subscriptions(t))
    return rows.filter(F.col("reason") == reason).select(
        "invoice_id", "customer", "invoice_status", "product_name", "subscription_status", "reason", "subscription_start"
    )


def table_contents(t: BillingTables) -> DataFrame:
    """Rows of every table of the layout, and a sum over a digest of all columns of each row."""
    def digest(names: list[str]) -> Column:
        texts = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("~")) for name in names]
        return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("long")

    summed = [
        getattr(t, name)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.sum(digest(StructType.fromDDL(schema).names)), F.lit(0)).alias("content"),
        )
        .select(F.lit(name).alias("table_name"), "row_count", "content")
        for name, schema in SCHEMAS[t.layout].items()
    ]
    return reduce(DataFrame.union, summed)


def not_in_variants(t: BillingTables) -> DataFrame:
    """Invoices whose charge is not in three lists: of known charges, with a NULL, empty."""
    lists = {
        "refunds": t.refunds.select("charge"),
        "unknown": t.invoices.filter("attempt_count = 0").select("charge"),
        "nothing": t.refunds.filter(F.lit(False)).select("charge"),
    }
    kept = [
        not_in(t.invoices, "charge", listed).select(F.lit(name).alias("variant"), "id", "charge")
        for name, listed in lists.items()
    ]
    return reduce(DataFrame.union, kept)


def running_invoices(t: BillingTables) -> DataFrame:
    """Invoices by month with running sums; over years alone, months of a year are peers."""
    start = epoch_timestamp(F.col("period_start"))
    months = t.invoices.groupBy(F.year(start).alias("year"), F.month(start).alias("month")).agg(
        F.count(F.lit(1)).alias("invoices")
    )
    return months.withColumns(
        {
            "so_far": F.sum("invoices").over(month_order()),
            "so_far_by_year": F.sum("invoices").over(Window.orderBy(F.asc_nulls_last("year"))),
        }
    )


def united_amounts(t: BillingTables) -> DataFrame:
    """Distinct product and amount: fractions of yearly lines, whole units of the others.

    The union goes by place, whatever the names, and whole numbers become fractions.
    """
    lines = invoice_lines(t, kind=None, product="price", interval=True, period=False)
    yearly = F.col("interval") == periods.YEAR
    fractions = lines.filter(yearly).select("product", money.fractional_units(F.col("amount")).alias("amount"))
    whole = lines.filter(~yearly).select(F.col("product").alias("amount"), money.whole_units("amount").alias("product"))
    return fractions.union(whole).distinct()


def yearly_months(t: BillingTables) -> DataFrame:
    """Twelve months of every yearly line, start and end generated in step."""
    lines = invoice_lines(t, kind=None, interval=True).filter(F.col("interval") == periods.YEAR)
    days = lines.select(
        "line_key", "interval", F.to_date("line_start").alias("first_day"), F.to_date("line_end").alias("last_day")
    )
    return periods.expand_periods(days).drop("interval")


def labelled_months(t: BillingTables) -> DataFrame:
    """Lines by padded month name."""
    named = invoice_lines(t, kind=None).select(month_label(F.to_date("line_start")).alias("month_name"))
    return named.groupBy("month_name").agg(
        F.count(F.lit(1)).alias("lines"), F.max(F.length("month_name")).alias("width")
    )


def net_amounts(t: BillingTables) -> DataFrame:
    """Every line and discount with the rounded net amount and its twelfth."""
    lines = invoice_lines(t, kind=None, period=False, discount=True)
    total = money.net_units(F.col("amount"), F.col("discount"))
    return lines.select("line_key", total.alias("total"), money.monthly_share(total).alias("share"))


def whole_amounts(t: BillingTables) -> DataFrame:
    """Amounts about zero in whole units, cut toward zero on both sides."""
    lines = t.invoice_line_items.select("id", (F.col("amount") - 3_000_000).alias("cents"))
    return lines.select("id", "cents", money.whole_units("cents").alias("units"))


def json_spans(t: BillingTables) -> DataFrame:
    """Start and end of every JSON line, quoted or not."""
    span = jsontext.epoch_range(F.col("period"))
    return t.invoice_line_items.select("id", span.getField("start").alias("start"), span.getField("end").alias("end"))


def step_queries(as_of: dt.datetime) -> dict[str, tuple[Step, Layout]]:
    """Steps by id, with the layout each is registered for."""
    keep, spread = periods.keep_invoice, arpu.revenue_by_month
    plain: dict[str, Step] = {
        "X01": table_contents,
        "X14": not_in_variants,
        "X26": running_invoices,
        "X31": united_amounts,
        "X32": yearly_months,
        "X44": labelled_months,
        "X49": net_amounts,
        "X51": whole_amounts,
        "P1": lambda t: keep(t, reason=True, cancel=True),
        "P1a": keep,
        "P1b": lambda t: keep(t, reason=True, cancel=True, drop_failed=True),
        "P1c": lambda t: keep(t, cancel=True, how="left"),
        "P1n": lambda t: keep(t, net=True),
        "P2": lambda t: _expanded(t, True, reason=True, cancel=True, net=True),
        "P2b": lambda t: _revenue_rows(t, True),
        "P2c": lambda t: _expanded(t, True, "left", cancel=True),
        "P3": lambda t: _expanded(t, False, reason=True, cancel=True, net=True),
        "P3b": lambda t: _revenue_rows(t, False),
        "P3c": lambda t: _expanded(t, False, "left", cancel=True),
        "P4": lambda t: periods.customer_periods(t, net=True),
        "P5": lambda t: _full(t, net=True),
        "P6": lambda t: periods.period_keys(_full(t)),
        "P7": lambda t: _neighbours(t, net=True),
        "P8": lambda t: _coded(t, as_of),
        "P8a": lambda t: _coded_left(t, as_of),
        "P8b": lambda t: _kept_reason(_coded(t, as_of)),
        "P9": lambda t: _churn(t, as_of, "moves", "moved_to_free"),
        "P10": lambda t: _churn(t, as_of, "lapses", "lapsed"),
        "P11": lambda t: movements.churn_by_month(
            _kept_reason(_coded(t, as_of, net=True)), "voluntary_churn_mrr"
        ),
        "P12": lambda t: _flagged(t, "upgrade"),
        "P13": lambda t: _moved(t, "upgrade"),
        "P14": lambda t: _flagged(t, "downgrade"),
        "P15": lambda t: _moved(t, "downgrade"),
        "P16": lambda t: _flagged(t, "reactivation"),
        "P17": lambda t: _moved(t, "reactivation"),
        "P18": lambda t: delinquency.failed_payments(t, net=True),
        "P19": lambda t: _failed_months(t).distinct(),
        "P20": lambda t: delinquency.months_per_customer(_failed_months(t)),
        "P21": lambda t: delinquency.delinquent_by_month(t, "customers"),
        "P22": _first_paid,
        "P23": lambda t: movements.new_customers_by_month(_first_paid(t), "new_customer_mrr"),
        "P24": lambda t: mrr.mrr_movements(t, as_of),
        "P25": _first_invoices,
        "P26": lambda t: counts.existing_customers(t, as_of).select(
            "year", "month", "existing_customers"
        ),
        "P27": lambda t: mrr.existing_mrr(t, as_of).select("year", "month", "existing_mrr"),
        "C1": analytics.invoiced_lines,
        "C2": analytics.live_subscriptions,
        "C3": lambda t: _as_text(analytics.paid_history(t), "plan_amount"),
        "C4": lambda t: _as_text(_changes(t), "next_subscription_price"),
        "C5": lambda t: analytics.changes_by_month(_changes(t)).select(
            "year", "month", "new_customer"
        ),
        "C6": lambda t: analytics.with_cumulative_new(
            analytics.changes_by_month(_changes(t))
        ).select("year", "month", "cumulative_new_customers"),
        "C7": analytics.ended_subscriptions,
        "C8": lambda t: _churned(t, analytics.REQUESTED),
        "C9": lambda t: _churned(t, periods.PAYMENT_FAILED),
        "C10": lambda t: spread(arpu.revenue_monthly(t)).withColumn(
            "total_revenue", F.round("total_revenue", 4)
        ),
        "C11": receivables.latest_entries,
        "C12": lambda t: analytics.changes_by_month(_changes(t)).select(
            "year", "month", "upgrades", "downgrades"
        ),
        "C13": lambda t: _as_text(
            analytics.churn_by_start_month(
                analytics.churned(t, analytics.ended_subscriptions(t))
            ),
            "year",
            "month",
        ),
        "C14": lambda t: analytics.customer_analytics(t).select(
            "year", "month", "existing_customers"
        ),
    }
    json: dict[str, Step] = {
        "X01j": table_contents,
        "X53": json_spans,
        "P1j": lambda t: keep(t, net=True),
        "P2a": lambda t: _expanded(t, True, reason=True, cancel=True, net=True),
        "P3a": lambda t: _expanded(t, False, reason=True, cancel=True, net=True),
    }
    return {
        **{key: (step, "normalized") for key, step in plain.items()},
        **{key: (step, "json") for key, step in json.items()},
    }
