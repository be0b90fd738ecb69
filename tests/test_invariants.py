"""Relations between metrics that hold on any data."""

import pytest
from pyspark.sql import functions as F

from subtally.catalog import AS_OF
from subtally.operators import movements, periods
from subtally.plans import arpu, counts, mrr
from subtally.sources.star import billing_tables

SF_DIR = "/root/testdata/sf0.001"
BOTH = pytest.mark.parametrize("layout", ["normalized", "json"])


@BOTH
def test_running_totals_are_sums_of_movements(spark, layout):
    t = billing_tables(spark, SF_DIR, layout)
    running = 0
    for r in counts.existing_customers(t, AS_OF).orderBy("year", "month").collect():
        running += r.new_customers - r.voluntary_churn + r.reactivations - r.delinquent_churn
        assert r.existing_customers == running
    running = 0.0
    for r in mrr.existing_mrr(t, AS_OF).collect():
        running += sum(r[2:8])
        assert r.existing_mrr == running


def test_arpu_is_revenue_over_customers(spark):
    t = billing_tables(spark, SF_DIR)
    months = {}
    for r in arpu.revenue_monthly(t).collect():
        key = (r.subscription_start.strftime("%B").ljust(9), r.subscription_start.year)
        total, customers = months.setdefault(key, [0.0, set()])
        months[key][0] = total + r.amount
        customers.add(r.customer)
    got = {(r.month_name, r.year): r.arpu_monthly for r in arpu.arpu_monthly(t).collect()}
    assert got == pytest.approx({k: total / len(c) for k, (total, c) in months.items()})


@BOTH
def test_a_period_moves_one_way(spark, layout):
    t = billing_tables(spark, SF_DIR, layout)
    keyed = periods.period_keys(periods.customer_periods(t, reason=True, cancel=True))
    flags = [flag() for flag in movements.FLAGS.values()]
    flags.append(movements.churn_code(AS_OF) == 1)
    moves = sum((F.when(flag, 1).otherwise(0) for flag in flags), F.lit(0))
    assert movements.with_neighbours(keyed).filter(moves > 1).count() == 0


def test_layouts_agree_on_single_line_invoices(spark):
    """With one line and at most one discount per invoice the layouts hold the same facts."""
    both = [billing_tables(spark, SF_DIR, layout) for layout in ("normalized", "json")]
    single = (
        both[0].invoice_line_items.groupBy("invoice_id").agg(F.count("*").alias("n"), F.min("id").alias("id"))
        .filter("n = 1").join(
            both[0].invoice_line_items_discount_amounts.groupBy(
                F.col("_airbyte_invoice_line_items_hashid").alias("id")
            ).agg(F.count("*").alias("d")), "id", "left",
        ).filter("coalesce(d, 0) <= 1").select("invoice_id")
    )
    sums = []
    for t in both:
        frames = dict(t.frames)
        frames["invoice_line_items"] = t.invoice_line_items.join(single, "invoice_id", "left_semi")
        sums.append(mrr.existing_mrr(type(t)(t.layout, frames), AS_OF).collect())
    assert sums[0] and sums[0] == sums[1]


def test_tables_are_lazy_or_written_to_the_named_folder(spark, tmp_path):
    lazy = counts.new_customer_count(billing_tables(spark, SF_DIR)).collect()
    stored = billing_tables(spark, SF_DIR, folder=str(tmp_path / "billing"))
    assert counts.new_customer_count(stored).collect() == lazy
    assert {p.name for p in (tmp_path / "billing").iterdir()} >= {"invoices", "lines"}
