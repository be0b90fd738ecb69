"""What a task holds when lines meet their invoices."""

import pytest
from pyspark.sql import functions as F

from subtally.operators import periods
from subtally.plans import mrr
from subtally.sources.schemas import LINE_HASH
from subtally.sources.star import billing_tables

SF_DIR = "/root/testdata/sf0.001"


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("layout", ["normalized", "json"])
def test_joined_lines_are_not_made_distinct_in_the_task_that_joins_them(spark, layout):
    """Distinct are the narrow lines before the join, and the months of a customer after it."""
    plan = _plan(mrr.upgrade_mrr(billing_tables(spark, SF_DIR, layout)))
    keys = [x.split("keys=[")[1].split("]")[0] for x in plan.split("\n") if "HashAggregate(keys=[" in x]
    wide = [x for x in keys if "invoice_id" in x and "customer" in x]
    narrow = [x for x in keys if "invoice_id" in x and "product" in x]
    assert not wide and len(narrow) == 2


def test_copies_of_lines_leave_the_periods_as_they_are(spark):
    """Lines many times over, and on other seconds of the day, are periods once."""
    t = billing_tables(spark, SF_DIR)
    names = ("invoice_line_items", "invoice_line_items_period", "invoice_line_items_price", "invoice_line_items_plan")
    copied = {name: getattr(t, name) for name in t.frames}
    copy = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy")
    for name in names:
        rows = copied[name].select("*", copy).withColumn(LINE_HASH, F.concat_ws("#", LINE_HASH, "copy"))
        if name.endswith("_period"):
            rows = rows.withColumns({"start": F.col("start") + F.col("copy"), "end": F.col("end") + F.col("copy")})
        copied[name] = rows.drop("copy")
    more = type(t)(t.layout, copied)
    once, often = periods.customer_periods(t), periods.customer_periods(more)
    assert once.count() > 0 and once.exceptAll(often).isEmpty() and often.exceptAll(once).isEmpty()
    kept = periods.keep_invoice(more)
    assert periods.billed_lines(more, kept, "line").count() == 3 * periods.billed_lines(t, kept, "line").count()
