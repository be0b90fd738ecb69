"""Plan shapes that have to survive large data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from subtally import catalog_tables, read_tables
from subtally.functions import jsontext
from subtally.plans import counts, mrr
from subtally.sources.schemas import SCHEMAS
from subtally.sources.star import billing_tables
from subtally.sources.tables import store_tables

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unsized(spark):
    """No side is small enough to be broadcast, as on large tables."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("key", [k for k in QUERIES if k.startswith("Q")])
def test_no_join_needs_a_small_side(unsized, key):
    plan = _plan(QUERIES[key](unsized, SF_DIR))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "EvalPython",
                      "InPandas", "BatchEvalPython"):
        assert forbidden not in plan


def test_scan_is_pruned_and_filtered(spark, tmp_path):
    stored = billing_tables(spark, SF_DIR, folder=str(tmp_path / "billing"))
    plan = _plan(counts.upgrades(stored))
    assert "EqualTo(status,paid)" in plan and "EqualTo(type,subscription)" in plan
    assert "discounts" not in plan and "charge" not in plan


def _exchanges(plan):
    return [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "Reused" not in x]


def test_combined_metrics_shuffle_periods_once(spark):
    """Lines move to their customer once; months, distinct and windows stay there."""
    for key in ("Q13", "Q20", "Q27", "Q34"):
        plan = _plan(QUERIES[key](spark, SF_DIR))
        assert sum("REPARTITION_BY_COL" in x for x in _exchanges(plan)) == 1
        assert not any("subscription_start" in x for x in _exchanges(plan))
        assert plan.count("Generate inline") == 1


def test_both_reads_of_lines_share_their_shuffles(unsized):
    frame = QUERIES["Q08"](unsized, SF_DIR)
    frame.collect()
    final = _plan(frame).split("== Initial Plan ==")[0]
    reused = [x for x in final.split("\n") if "ReusedExchange" in x]
    assert any("invoice_id" in x for x in reused) and any("to_epoch" in x for x in reused)


def test_bucketed_lines_join_without_shuffle(unsized, tmp_path):
    t = billing_tables(unsized, SF_DIR)
    unsized.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}'")
    store_tables(t, "bucketed", 4)
    stored = catalog_tables(unsized, "bucketed")
    result = counts.upgrades(stored)
    assert not any("line_key" in x or "hashid" in x for x in _exchanges(_plan(result)))
    assert result.collect() == counts.upgrades(t).collect()


def test_tables_read_back_from_files(spark, tmp_path):
    t = billing_tables(spark, SF_DIR, "json")
    for name in SCHEMAS["json"]:
        getattr(t, name).write.parquet(f"{tmp_path}/{name}")
    again = read_tables(spark, str(tmp_path), "json")
    assert counts.upgrades(again).collect() == counts.upgrades(t).collect()
    with pytest.raises(AttributeError):
        again.invoice_line_items_period


def test_failed_subscriptions_share_their_shuffles(unsized):
    """The second read of the failed subscriptions reuses the reasons and the dated ids of the first."""
    frame = QUERIES["Q12"](unsized, SF_DIR)
    frame.collect()
    final = _plan(frame).split("\n+- == Initial Plan ==")[0]
    reused = [x for x in final.split("\n") if "ReusedExchange" in x]
    assert any("ReusedExchange [_airbyte_subscriptions_hashid" in x for x in reused)
    assert any("ReusedExchange [id#" in x for x in reused)


def test_each_json_document_is_parsed_once_for_all_lines(spark, tmp_path):
    """The first read of the lines parses periods, the second products and intervals."""
    stored = billing_tables(spark, SF_DIR, "json", folder=str(tmp_path / "billing"))
    plan = _plan(mrr.upgrade_mrr(stored))
    assert plan.count("from_json") == 1
    for path in ("$['product']", "$['interval']", "$[0].amount"):
        projected = [x for x in plan.split("\n") if "Project" in x or "partial_min" in x]
        assert sum(path in x for x in projected) == 1


@pytest.mark.parametrize("document,start", [
    ('{"start":5,"end":6}', 5), ('{"start":"5","end":"6"}', 5), ('{"end":6,"start":4102444800}', 4102444800),
    ('{"start":null,"end":6}', None), ('{"end":6}', None), (None, None), ('{"x":{"start":1},"start":2}', 2),
])
def test_json_epochs(spark, document, start):
    frame = spark.createDataFrame([(document,)], "d string").select(jsontext.epoch_range(F.col("d")).alias("s"))
    assert frame.select("s.start").first()[0] == start


@pytest.mark.parametrize("document,amount", [
    ("[]", None), (None, None), ('[{"amount":3},{"amount":4}]', 3.0), ('[{"amount":"3"}]', 3.0),
    ('[{"amount":null},{"amount":4}]', None), ('[{"other":1}]', None),
])
def test_json_first_amounts(spark, document, amount):
    frame = spark.createDataFrame([(document,)], "d string").select(jsontext.first_amount(F.col("d")))
    assert frame.first()[0] == amount
