
import datetime as dt

import pytest
from pyspark.sql import functions as F

from subtally.functions.dates import clock, month_label, month_starts
from subtally.operators import delinquency, movements, periods
from subtally.operators.grouping import not_in
from subtally.plans import analytics, arpu, counts, mrr, receivables
from tests.ledger import epoch, invoice, ledger, line, rows, subscription

BOTH = pytest.mark.parametrize("layout", ["normalized", "json"])
NORMALIZED = "normalized"
AS_OF = dt.datetime(2023, 6, 15, tzinfo=dt.timezone.utc)


def days(*texts):
    return [dt.date.fromisoformat(t) for t in texts]


@BOTH
def test_yearly_line_steps_from_month_end(spark, layout):
    t = ledger(spark, layout, [invoice("i1")],
               [line("i1", "2023-01-31", "2024-01-31", interval="year")])
    got = periods.customer_periods(t).orderBy("subscription_start").collect()
    starts = [r.subscription_start for r in got]
    assert starts[:4] == days("2023-01-31", "2023-02-28", "2023-03-28", "2023-04-28")
    assert starts[-1] == dt.date(2023, 12, 28)
    # Starts and ends advance together: twelve rows, not 144.
    assert len(got) == 12
    assert [r.subscription_end for r in got][:-1] == starts[1:]


def test_month_starts_on_every_day_of_leap_and_common_years(spark):
    def step(day):
        year, month = divmod(day.year * 12 + day.month, 12)
        last = (dt.date(year + (month == 11), (month + 1) % 12 + 1, 1) - dt.timedelta(1)).day
        return dt.date(year, month + 1, min(day.day, last))

    first = dt.date(2023, 1, 1)
    got = spark.range(0, 3 * 366).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("d")
    ).select("d", month_starts(F.col("d")).alias("s")).collect()
    for r in got:
        expected = [r.d]
        for _ in range(11):
            expected.append(step(expected[-1]))
        assert r.s == expected


@BOTH
@pytest.mark.parametrize("amount,total", [(250, 2.0), (350, 4.0), (None, 0.0), (-250, -2.0)])
def test_net_total_rounds_half_to_even(spark, layout, amount, total):
    t = ledger(spark, layout, [invoice("i1")], [line("i1", "2023-01-01", "2023-02-01", amount=amount)])
    assert [r.total for r in periods.customer_periods(t, net=True).collect()] == [total]


@pytest.mark.parametrize("cents,unit", [(999, 9), (-999, -9), (1000, 10), (None, None)])
def test_unit_amount_is_cut_toward_zero(spark, cents, unit):
    t = ledger(spark, NORMALIZED, [invoice("i1")], [line("i1", "2023-01-01", "2023-02-01")],
               prices={"p1": [cents]})
    assert [r.unit_amount for r in periods.customer_periods(t).collect()] == [unit]


def test_revenue_mixes_fractions_and_whole_units(spark):
    t = ledger(spark, NORMALIZED,
               [invoice("i1", total_excluding_tax=1999), invoice("i2", "c2", total_excluding_tax=1999)],
               [line("i1", "2023-01-05", "2024-01-05", interval="year"),
                line("i2", "2023-01-05", "2023-02-05")],
               prices={"p1": [1990]})
    got = arpu.revenue_monthly(t)
    by_id = {r.id: r for r in got.collect()}
    assert got.filter("id = 'i1'").count() == 12
    assert by_id["i1"].amount == pytest.approx(1999 / 100 / 12)
    assert by_id["i1"].unit_amount == pytest.approx(1990 / 100 / 12)
    assert (by_id["i2"].amount, by_id["i2"].unit_amount) == (19.0, 19.0)


@pytest.mark.parametrize("refunds,left", [
    ([], ["i1", "i2", "i3"]),
    (["ch_i1"], ["i2"]),
    (["ch_other"], ["i1", "i2"]),
    (["ch_i1", None], []),
    ([None], []),
])
def test_not_in_follows_sql_nulls(spark, refunds, left):
    frame = spark.createDataFrame([("i1", "ch_i1"), ("i2", "ch_i2"), ("i3", None)], "id string, charge string")
    values = spark.createDataFrame([(r,) for r in refunds], "charge string")
    assert sorted(r.id for r in not_in(frame, "charge", values).collect()) == left
    frame.createOrReplaceTempView("charged")
    values.createOrReplaceTempView("refunded")
    sql = spark.sql("SELECT id FROM charged WHERE charge NOT IN (SELECT charge FROM refunded)")
    assert sorted(r.id for r in sql.collect()) == left


def test_null_refund_empties_arpu(spark):
    t = ledger(spark, NORMALIZED, [invoice("i1")], [line("i1", "2023-01-05", "2023-02-05")], refunds=[None])
    assert arpu.arpu_monthly(t).count() == 0


def test_month_name_is_padded(spark):
    got = spark.sql("SELECT date '2023-05-01' d").select(month_label(F.col("d"))).first()[0]
    assert got == "May      "


def test_union_is_distinct(spark):
    """Equal periods from two lines of one invoice count once."""
    t = ledger(spark, NORMALIZED, [invoice("i1")],
               [line("i1", "2023-01-01", "2023-02-01", n=1), line("i1", "2023-01-01", "2023-02-01", n=2)])
    assert periods.customer_periods(t).count() == 1


@BOTH
def test_second_price_doubles_delinquent_money(spark, layout):
    t = ledger(
        spark, layout,
        [invoice("i1"), invoice("i2")],
        [line("i1", "2023-01-01", "2023-02-01"), line("i2", "2023-02-01", "2023-03-01")],
        [subscription(latest_invoice="i2", status="canceled", reason="payment_failed",
                      cancel_at=epoch("2023-02-20"))],
        prices={"p1": [1000, 2000]},
    )
    assert rows(mrr.delinquent_mrr(t)) == [(2, 2023, 20.0)]
    assert rows(counts.delinquent_churn(t)) == [(2, 2023, 1)]


@BOTH
def test_one_invoice_month_is_not_delinquent(spark, layout):
    t = ledger(
        spark, layout, [invoice("i1")],
        [line("i1", "2023-01-01", "2023-02-01", n=1), line("i1", "2023-01-20", "2023-02-20", n=2)],
        [subscription(latest_invoice="i1", reason="payment_failed", canceled_at=epoch("2023-02-20"))],
    )
    assert rows(counts.delinquent_churn(t)) == []


@BOTH
def test_failed_subscription_needs_a_cancel_date(spark, layout):
    t = ledger(
        spark, layout, [invoice("i1"), invoice("i2")],
        [line("i1", "2023-01-01", "2023-02-01"), line("i2", "2023-02-01", "2023-03-01")],
        [subscription(latest_invoice="i2", reason="payment_failed")],
    )
    assert rows(counts.delinquent_churn(t)) == []


def _paid_then_free(spark, layout, reason):
    """January paid, February paid, March free; a failed-payment subscription or not."""
    invoices = [invoice(f"i{m}") for m in (1, 2, 3)]
    lines = [
        line("i1", "2023-01-01", "2023-02-01"),
        line("i2", "2023-02-01", "2023-03-01"),
        line("i3", "2023-03-01", "2023-04-01", product="free"),
    ]
    return ledger(spark, layout, invoices, lines, [subscription(reason=reason)],
                  prices={"p1": [1000], "free": [0]})


@BOTH
def test_moved_to_free_is_voluntary_churn(spark, layout):
    t = _paid_then_free(spark, layout, None)
    assert rows(counts.voluntary_churn(t, AS_OF)) == [(3, 2023, 1)]
    assert rows(mrr.voluntary_churn_mrr(t, AS_OF)) == [(3, 2023, -10.0)]


@BOTH
def test_failed_payment_is_dropped_early_or_late(spark, layout):
    t = _paid_then_free(spark, layout, "payment_failed")
    assert periods.customer_periods(t, cancel=True, drop_failed=True).count() == 0
    combined = periods.customer_periods(t, cancel=True, reason=True)
    assert combined.count() == 3
    assert rows(counts.voluntary_churn(t, AS_OF)) == []
    month = counts.existing_customers(t, AS_OF).first()
    assert (month.new_customers, month.voluntary_churn) == (1, 0)


def test_outer_variant_keeps_failed_and_unknown(spark):
    t = _paid_then_free(spark, NORMALIZED, "payment_failed")
    assert rows(counts.voluntary_churn_left(t, AS_OF)) == [(3, 2023, 1)]
    unknown = ledger(spark, NORMALIZED, [invoice("i1"), invoice("i2")],
                     [line("i1", "2023-01-01", "2023-02-01"),
                      line("i2", "2023-02-01", "2023-03-01", product="nameless")])
    got = periods.customer_periods(unknown, cancel=True, how="left")
    assert rows(got.select("product_name", "unit_amount")) == [("plan p1", 10), (None, None)]
    assert periods.customer_periods(unknown, cancel=True).count() == 0


@BOTH
def test_cancel_winner_before_drop_leaves_the_month_empty(spark, layout):
    """The rank is taken first: a failed winner does not hand its month to another."""
    t = ledger(
        spark, layout,
        [invoice("i1", subscription="s_ok"), invoice("i2", subscription="s_bad")],
        [line("i1", "2023-01-01", "2023-02-01"), line("i2", "2023-01-10", "2023-02-10")],
        [subscription(id="s_ok"), subscription(id="s_bad", reason="payment_failed")],
    )
    assert periods.keep_invoice(t, reason=True, cancel=True, drop_failed=True).count() == 0


@pytest.mark.parametrize("layout,starts", [
    ("normalized", days("2023-01-03", "2023-01-20")), ("json", days("2023-01-20"))])
def test_period_of_line_or_of_kept_line(spark, layout, starts):
    t = ledger(spark, layout, [invoice("i1")],
               [line("i1", "2023-01-03", "2023-02-03", n=1), line("i1", "2023-01-20", "2023-02-20", n=2)])
    got = periods.customer_periods(t).select("subscription_start").collect()
    assert sorted(r[0] for r in got) == starts


@pytest.mark.parametrize("layout,candidates,total", [("normalized", 2, 9.0), ("json", 1, 7.0)])
def test_discounts_multiply_lines_or_first_counts(spark, layout, candidates, total):
    from subtally.operators.lines import invoice_lines

    t = ledger(spark, layout, [invoice("i1")],
               [line("i1", "2023-01-01", "2023-02-01", discounts=[300, 100])])
    assert invoice_lines(t, discount=True).count() == candidates
    assert periods.keep_invoice(t, net=True).first().total == total


@pytest.mark.parametrize("own,others,total", [
    ([], [[300, 100]], 7.0),
    ([], [[], [200]], 8.0),
    ([500], [[], []], 5.0),
    ([500], [[300, 900]], 7.0),  # which row counts is open: the smallest first element
    ([], [[], []], 10.0),
])
def test_json_discount_hangs_on_the_line_id(spark, own, others, total):
    """Rows of other invoices and types count, when they have the line's id."""
    t = ledger(
        spark, "json", [invoice("i1")],
        [line("i1", "2023-01-01", "2023-02-01", id="same", discounts=own)]
        + [line(f"x{i}", "2023-01-01", "2023-02-01", id="same", type="invoiceitem", discounts=d)
           for i, d in enumerate(others)]
        + [line("i2", "2023-01-01", "2023-02-01", id="another", discounts=[50])],
    )
    assert [r.total for r in periods.keep_invoice(t, net=True).collect()] == [total]


def test_json_line_without_id_has_no_discount(spark):
    t = ledger(spark, "json", [invoice("i1")],
               [line("i1", "2023-01-01", "2023-02-01", id=None, discounts=[300])])
    assert [r.total for r in periods.keep_invoice(t, net=True).collect()] == [10.0]


def test_delinquent_json_lines_share_the_discount_of_their_id(spark):
    t = ledger(
        spark, "json", [invoice("i1")],
        [line("i1", "2023-01-01", "2023-02-01", id="same"), line("i9", "2023-01-01", "2023-02-01", id="same", discounts=[300])],
        [subscription(latest_invoice="i1", canceled_at=1, reason="payment_failed")],
    )
    assert [r.total for r in delinquency.failed_payments(t, net=True).collect()] == [7.0]


@BOTH
def test_lapse_without_free_move_is_lost(spark, layout):
    t = ledger(spark, layout, [invoice("i1")], [line("i1", "2023-01-01", "2023-02-01")], [subscription()])
    coded = movements.with_neighbours(
        periods.period_keys(periods.customer_periods(t, cancel=True, drop_failed=True))
    ).withColumn("churn", movements.churn_code(AS_OF))
    assert [r.churn for r in coded.collect()] == [2]
    assert rows(counts.voluntary_churn(t, AS_OF)) == []


@BOTH
@pytest.mark.parametrize("start,end,code", [
    ("2023-06-01", "2023-07-01", 0),   # current month
    ("2023-05-20", "2023-06-20", 0),   # not ended yet
    ("2023-05-10", "2023-06-10", 2),
])
def test_last_paid_period_lapses_when_over(spark, layout, start, end, code):
    t = ledger(spark, layout, [invoice("i1")], [line("i1", start, end)], [subscription()])
    keyed = periods.period_keys(periods.customer_periods(t, cancel=True))
    got = movements.with_neighbours(keyed).select(movements.churn_code(AS_OF)).collect()
    assert [r[0] for r in got] == [code]


def test_outer_variant_does_not_wait_for_the_end(spark):
    t = ledger(spark, NORMALIZED, [invoice("i1")], [line("i1", "2023-05-20", "2023-06-20")], [subscription()])
    keyed = periods.period_keys(periods.customer_periods(t, cancel=True))
    got = movements.with_neighbours(keyed).select(movements.churn_code(AS_OF, False)).collect()
    assert [r[0] for r in got] == [2]


@BOTH
def test_price_moves(spark, layout):
    """10, 20, 5, 0, 5: up, down, to free, back."""
    prices = {"a": [1000], "b": [2000], "c": [500], "free": [0]}
    order = ["a", "b", "c", "free", "c"]
    invoices = [invoice(f"i{m}") for m in range(1, 6)]
    lines = [
        line(f"i{m}", f"2023-0{m}-01", f"2023-0{m + 1}-01", product=p, amount=prices[p][0])
        for m, p in enumerate(order, 1)
    ]
    t = ledger(spark, layout, invoices, lines, [subscription()], prices=prices)
    assert rows(counts.upgrades(t)) == [(2, 2023, 1)]
    assert rows(counts.downgrades(t)) == [(3, 2023, 1)]
    assert rows(counts.reactivations(t)) == [(5, 2023, 1)]
    assert rows(mrr.upgrade_mrr(t)) == [(2, 2023, 10.0)]
    assert rows(mrr.downgrade_mrr(t)) == [(3, 2023, -15.0)]
    assert rows(mrr.reactivation_mrr(t)) == [(5, 2023, 5.0)]
    assert rows(mrr.new_customer_mrr(t)) == [(1, 2023, 10.0)]
    # Only January has a new customer, so only January is reported.
    assert rows(counts.existing_customers(t, AS_OF)) == [(1, 2023, 1, 0, 0, 0, 0, 0, 1)]
    assert rows(mrr.existing_mrr(t, AS_OF)) == [(2023, 1, 10.0, 0.0, 0.0, 0.0, 0.0, 0.0, 10.0)]


@BOTH
def test_cancel_cut_only_in_combined_metrics(spark, layout):
    """Periods ending after the cancel date count for upgrades but not for the total."""
    t = ledger(
        spark, layout, [invoice("i1"), invoice("i2")],
        [line("i1", "2023-01-01", "2023-02-01"), line("i2", "2023-02-01", "2023-03-01", product="b")],
        [subscription(reason="cancellation_requested", canceled_at=epoch("2023-02-01"))],
        prices={"p1": [1000], "b": [2000]},
    )
    assert rows(counts.upgrades(t)) == [(2, 2023, 1)]
    assert counts.existing_customers(t, AS_OF).first().upgrades == 0
    assert periods.customer_periods(t, cancel=True).count() == 1


@BOTH
def test_cancel_date_is_compared_at_midnight(spark, layout):
    lines = [line("i1", "2023-01-01", "2023-02-01")]
    for hour, kept in ((0, 1), (5, 1)):
        subs = [subscription(canceled_at=epoch("2023-02-01", hour))]
        t = ledger(spark, layout, [invoice("i1")], lines, subs)
        assert periods.customer_periods(t, cancel=True).count() == kept
    t = ledger(spark, layout, [invoice("i1")], lines, [subscription(canceled_at=epoch("2023-01-31", 23))])
    assert periods.customer_periods(t, cancel=True).count() == 0


@BOTH
def test_yearly_price_is_compared_whole(spark, layout):
    """A yearly price of 100 after 10 a month is an upgrade; its money is a twelfth."""
    t = ledger(
        spark, layout, [invoice("i1"), invoice("i2")],
        [line("i1", "2023-01-01", "2023-02-01"),
         line("i2", "2023-02-01", "2024-02-01", product="y", interval="year", amount=12600)],
        prices={"p1": [1000], "y": [10000]},
    )
    assert rows(counts.upgrades(t)) == [(2, 2023, 1)]
    # 126 / 12 is 10.5, rounded to the even 10.
    assert rows(mrr.upgrade_mrr(t)) == [(2, 2023, 0.0)]


@BOTH
def test_late_epoch_does_not_overflow(spark, layout):
    t = ledger(spark, layout, [invoice("i1")], [line("i1", "2040-01-01", "2040-02-01")])
    assert rows(counts.new_customer_count(t)) == [(1, 2040, 1)]


@BOTH
def test_line_without_interval_has_no_period(spark, layout):
    t = ledger(spark, layout, [invoice("i1")], [line("i1", "2023-01-01", "2023-02-01", interval=None)])
    assert periods.customer_periods(t).count() == 0


@BOTH
def test_first_invoice_needs_a_subtotal(spark, layout):
    t = ledger(
        spark, layout,
        [invoice("i1", subtotal=0), invoice("i2"), invoice("i3", status="open")],
        [line("i1", "2023-01-01", "2023-02-01"), line("i2", "2023-02-01", "2023-03-01"),
         line("i3", "2022-01-01", "2022-02-01")],
    )
    assert rows(counts.new_customer_count(t)) == [(2, 2023, 1)]


def test_json_numbers_may_be_quoted(spark):
    from subtally.functions.jsontext import epoch_range, first_amount, field

    row = spark.createDataFrame(
        [('{"start": "5", "end": 7}', '[{"amount": 3}, {"amount": 4}]', '{"reason": null}')],
        "p string, d string, c string",
    ).select(epoch_range(F.col("p")).alias("p"), first_amount(F.col("d")).alias("d"),
             field(F.col("c"), "reason").alias("r")).first()
    assert (row.p.start, row.p.end, row.d, row.r) == (5, 7, 3.0, None)


def test_pending_payment_looks_at_the_latest_entry(spark):
    old, new = dict(period_start=epoch("2023-01-01")), dict(period_start=epoch("2023-02-01"))
    t = ledger(
        spark, NORMALIZED,
        [invoice("i1", status="open", **old), invoice("i2", **new),
         invoice("i3", "c2", **old), invoice("i4", "c2", status="open", **new),
         invoice("i5", "c3", status="open", billing_reason="subscription_create", **new)],
        [line(i, "2023-01-01", "2023-02-01") for i in ("i1", "i2", "i3", "i4", "i5")],
        intents={"i1": "processing", "i4": "processing", "i5": "processing"},
    )
    assert [r.invoice_id for r in receivables.pending_payments(t).collect()] == ["i4"]


def test_cancelled_subscriptions(spark):
    t = ledger(spark, NORMALIZED, [], [],
               [subscription("c1", reason="payment_failed", cancel_at=epoch("2023-02-03", 13)),
                subscription("c2", reason="payment_failed"), subscription("c3", canceled_at=5)])
    got = receivables.cancelled_subscriptions(t).collect()
    assert [(r.id, r.cancel_at, r.cancelled_at) for r in got] == [("s_c1", dt.date(2023, 2, 3), None)]


def test_analytics_nulls_and_live_customers(spark):
    """A NULL subscription before makes a row new again; live customers do not churn."""
    t = ledger(
        spark, NORMALIZED,
        [invoice("i1", subscription=None), invoice("i2"), invoice("i3"), invoice("i4", "c2"),
         invoice("i5", "c3", paid=None)],
        [line("i1", "2023-01-01", "2023-02-01"), line("i2", "2023-02-01", "2023-03-01", product="b"),
         line("i3", "2023-03-01", "2023-04-01"), line("i4", None, None),
         line("i5", "2023-01-01", "2023-02-01")],
        [subscription("c1", id="s_old", status="canceled", latest_invoice="i3",
                      reason="cancellation_requested"),
         subscription("c2", status="canceled", latest_invoice="i4", reason="payment_failed"),
         subscription("c4")],
        prices={"p1": [1000], "b": [2000]},
    )
    assert [tuple(r) for r in analytics.customer_analytics(t).collect()] == [
        (2023, 1, 1, None, None, 1, 0, 0),
        (2023, 2, 1, 1, 0, 2, 0, 0),
        (2023, 3, 0, 0, 1, 1, 1, 0),
        (None, None, 1, None, None, None, 0, 0),
    ]
    live = subscription("c1", id="s_live")
    frames = dict(t.frames)
    again = ledger(spark, NORMALIZED, [], [], [live])
    frames["subscriptions"] = frames["subscriptions"].union(again.subscriptions)
    kept = analytics.customer_analytics(type(t)(NORMALIZED, frames)).filter("month = 3").first()
    assert kept.voluntary_churned_customer == 0


def test_clock_needs_a_zone(spark):
    with pytest.raises(ValueError):
        clock(dt.datetime(2023, 1, 1))
