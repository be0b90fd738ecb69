"""Stored tables in which one invoice holds most lines: no task gets them all."""

import pytest
from pyspark.sql import functions as F

from subtally import catalog_tables
from subtally.operators.lines import invoice_lines, with_lines
from subtally.plans import counts, mrr
from subtally.sources.schemas import HOT_INVOICES, SALT
from subtally.sources.tables import store_tables
from tests.ledger import invoice, ledger, line, rows, subscription

BUCKETS = 8
HOT_LINES = 4000


@pytest.fixture
def unsized(spark):
    """Nothing is broadcast; every partition above 256 bytes counts as skewed."""
    eager = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256b",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": str(BUCKETS),
    }
    before = {key: spark.conf.get(key) for key in eager}
    for key, value in eager.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def _tables(spark, layout):
    """Two thirds of the lines on one invoice, the others on 500."""
    ids = ["hot", *[f"i{n}" for n in range(500)]]
    lines = [line("hot", "2023-01-31", "2023-02-28", n=n, amount=n, product="p1" if n % 3 else "p2",
                  interval="month" if n % 5 else "year", discounts=[n % 7]) for n in range(HOT_LINES)]
    lines += [line(i, f"2023-0{n % 9 + 1}-05", f"2023-0{n % 9 + 1}-25", n=n) for i in ids[1:] for n in range(4)]
    lines += [line(None, "2023-01-01", "2023-02-01", n=n) for n in range(50)]
    return ledger(
        spark, layout, [invoice(i, customer=f"c{n % 40}") for n, i in enumerate(ids)], lines,
        [subscription(f"c{n}") for n in range(40)], prices={"p1": [1000], "p2": [0, 2500]},
    )


def _stored(spark, layout, tmp_path):
    t = _tables(spark, layout)
    database = f"salted_{layout}"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}'")
    store_tables(t, database, BUCKETS)
    return t, catalog_tables(spark, database, layout)


def _largest_task(frame):
    """Share of the rows in the fullest task."""
    whole = frame.select(F.spark_partition_id().alias("task"), F.xxhash64(*frame.columns).alias("all"))
    sizes = whole.groupBy("task").agg(F.count("all").alias("n"), F.max("all")).collect()
    return max(r.n for r in sizes) / sum(r.n for r in sizes)


@pytest.mark.parametrize("layout", ["json", "normalized"])
def test_hot_invoice_is_no_single_task(unsized, tmp_path, layout):
    t, stored = _stored(unsized, layout, tmp_path)
    invoices = stored.invoices.select(F.col("id").alias("invoice_id"), "customer")
    joined = with_lines(stored, invoices, invoice_lines(stored))
    assert joined.count() == HOT_LINES + 2000 and SALT not in joined.columns
    assert _largest_task(joined) <= 0.35  # two thirds of the lines lie on one invoice


def test_salted_lines_are_not_shuffled(unsized, tmp_path):
    _, stored = _stored(unsized, "json", tmp_path)
    (hot,) = getattr(stored, HOT_INVOICES).collect()
    assert hot.invoice_id == "hot" and 4 <= hot.parts <= BUCKETS
    invoices = stored.invoices.select(F.col("id").alias("invoice_id"), "customer")
    joined = with_lines(stored, invoices, invoice_lines(stored))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    lines_side = plan[plan.rindex("Sort [invoice_id") :]
    assert "SelectedBucketsCount: 8" in lines_side and "Exchange" not in lines_side


@pytest.mark.parametrize("layout", ["json", "normalized"])
def test_stored_tables_give_the_same_metrics(unsized, tmp_path, layout):
    t, stored = _stored(unsized, layout, tmp_path)
    for metric in (counts.new_customer_count, counts.upgrades, counts.delinquent_churn, mrr.upgrade_mrr):
        assert rows(metric(stored)) == rows(metric(t))
