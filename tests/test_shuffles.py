"""What is shuffled, and how often: findings of round 4 on disk."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subtally.catalog import AS_OF
from subtally.operators import delinquency, periods
from subtally.operators.grouping import may_be_in
from subtally.plans import mrr
from subtally.sources.star import billing_tables
from tests.ledger import invoice, ledger, line, rows, subscription

DAY = dt.datetime(2000, 1, 1)


def _final(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0].split("\n")


def _made(plan, *words):
    """Exchanges that are made, not reused, and hold all of the words."""
    return [x for x in plan if "Exchange " in x and "Reused" not in x and all(w in x for w in words)]


@pytest.fixture
def unsized(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def star(spark, tmp_path):
    """Orders of three lines; an order without lines, a line without an order, unknown values, a row twice."""
    n = range(1, 41)
    lines = [(k, k + i, 1, i, 10.0 * i, 0.05 * i, "NRA"[i % 3]) for k in n for i in range(1, 4)]
    lines += [lines[0], (999, 1, 1, 1, 10.0, 0.0, "N"), (1, None, 1, None, 10.0, None, None), (None, 1, 1, 1, 1.0, 0.0, "N")]
    tables = {
        "customer": ([(c,) for c in range(1, 13)], "c_custkey long"),
        "part": ([(p,) for p in range(1, 41)], "p_partkey long"),
        "orders": (
            [(k, k % 12 + 1, "F", 10.0, DAY + dt.timedelta(days=9 * k)) for k in [*n, 500]] + [(7, 3, "F", 10.0, None)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
        ),
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
            "l_discount double, l_returnflag string",
        ),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("layout", ["normalized", "json"])
def test_lines_meet_their_orders_once(unsized, star, layout):
    """All tables cut from the lines, with other columns and filters each, share the shuffles below them."""
    plan = _final(mrr.existing_mrr(billing_tables(unsized, star, layout), AS_OF))
    assert len(_made(plan, "hashpartitioning(l_orderkey")) == 2
    if layout == "normalized":
        assert len(_made(plan, "REBALANCE")) == 1
        assert not _made(plan, "hashpartitioning(line_key")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_outer_reads_share_them_too(unsized, star, how):
    plan = _final(periods.customer_periods(billing_tables(unsized, star), cancel=True, how=how))
    assert len(_made(plan, "REBALANCE")) == 1


def test_the_tables_hold_every_line(spark, star):
    """Also lines whose id is unknown, and those of an order that occurs twice."""
    t = billing_tables(spark, star)
    assert t.invoice_line_items.count() == t.invoice_line_items_period.count() == 3 * 41 + 2
    assert t.invoice_line_items.filter("id IS NULL").count() == 1
    assert t.invoice_line_items_period.filter("start IS NULL").count() == 3 + 1
    assert t.invoice_line_items_plan.count() == 3 * 41 + 2


def test_subscriptions_meet_invoices_before_lines(unsized):
    """Lines, which are more, do not move to their subscription."""
    t = ledger(
        unsized, "normalized", [invoice("i1"), invoice("i2", "c2"), invoice("i3", "c3", subscription=None)],
        [line(i, "2023-01-01", "2023-02-01", n=n) for i in ("i1", "i2", "i3") for n in (1, 2)],
        [subscription("c1"), subscription("c1", canceled_at=1), subscription("c2", reason="payment_failed")],
    )
    for how, customers in (("inner", ["c1", "c2"]), ("left", ["c1", "c2", "c3"])):
        kept = periods.keep_invoice(t, reason=True, cancel=True, how=how)
        assert [(r.customer, r.status) for r in kept.orderBy("customer").collect()] == [(c, "paid") for c in customers]
        plan = kept._jdf.queryExecution().executedPlan().toString().split("\n")
        moved = [plan[i + 1] for i, x in enumerate(plan) if "Exchange hashpartitioning(subscription" in x]
        assert moved and not any("line_key" in x for x in moved)
        joins = [i for i, x in enumerate(plan) if "Join [" in x]
        by_subscription = [i for i in joins if "Join [subscription" in plan[i]]
        assert min(i for i in joins if "Join [invoice_id" in plan[i]) < min(by_subscription)


@pytest.mark.parametrize("listed", [[], ["k1"], ["k1", "k1", None], [f"k{i}" for i in range(0, 1000, 2)]])
def test_a_filter_of_keys_loses_nothing(spark, listed):
    frame = spark.createDataFrame([(f"k{i}",) for i in range(1000)] + [(None,)], "key string")
    values = spark.createDataFrame([(v,) for v in listed], "value string")
    left = [r.key for r in may_be_in(frame, "key", values).collect()]
    known = {v for v in listed if v is not None}
    assert known <= set(left) and None not in left and len(left) <= len(known) + 10


@pytest.mark.parametrize("layout", ["normalized", "json"])
def test_lines_of_other_invoices_are_dropped_before_they_move(unsized, layout):
    """Of 400 lines only those of the failed subscription's latest invoice are joined with the invoices."""
    t = ledger(
        unsized, layout, [invoice(f"i{n}", f"c{n}") for n in range(200)],
        [line(f"i{n}", "2023-01-01", "2023-02-01", n=k, discounts=[100]) for n in range(200) for k in (1, 2)],
        [subscription(f"c{n}", latest_invoice=f"i{n}", canceled_at=1, reason="payment_failed" if n == 7 else None) for n in range(200)],
    )
    failed = delinquency.failed_payments(t, net=True)
    assert [(r.invoice_id, r.total) for r in failed.collect()] == [("i7", 9.0)] * 2
    cut = [x for x in _final(failed) if "Filter" in x and "invoice_id" in x and "ubquery" in x]
    assert cut and rows(failed)
