"""Every registered query against DuckDB over the same star tables."""

import datetime as dt
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from oracle.base import REFUNDS, STAR, statement
from oracle.steps import all_statements
from subtally import read_tables, steps
from subtally.catalog import AS_OF, metric_queries, over_star, step_queries
from subtally.plans import counts
from subtally.session import ZONE
from subtally.sources.star import billing_tables

SF_DIR = os.environ.get("SUBTALLY_TEST_DIR", "/root/testdata/sf0.001")
QUERIES = {**metric_queries(), **step_queries()}
CHECKS = all_statements()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no star tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in ("orders", "lineitem", "customer", "part"):
        con.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime.combine(value, dt.time())
    return value


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_module.queries())


def test_every_line_item_is_a_line(spark, duck):
    (items,) = duck.execute("SELECT count(*) FROM lineitem").fetchone()
    for layout in ("normalized", "json"):
        lines = billing_tables(spark, SF_DIR, layout).invoice_line_items
        ids = lines.select("id").distinct().count()
        assert lines.count() == items and (ids == items if layout == "normalized" else ids < items)


@pytest.mark.parametrize("key", ["Q03", "Q13", "Q28"])
def test_results_do_not_depend_on_the_session_zone(spark, key):
    def rows():
        frame = QUERIES[key](spark, SF_DIR)
        return sorted(map(tuple, frame.selectExpr(*[f"CAST({c} AS STRING)" for c in frame.columns]).collect()))

    expected, zone = rows(), spark.conf.get(ZONE)
    try:
        spark.conf.set(ZONE, "Asia/Tokyo")
        assert spark.conf.get(ZONE) == "Asia/Tokyo"
        assert rows() == expected
        assert spark.conf.get(ZONE) == "Asia/Tokyo"
        with pytest.raises(ValueError):
            read_tables(spark, SF_DIR)
    finally:
        spark.conf.set(ZONE, zone)


@pytest.mark.parametrize("key", list(QUERIES))
def test_matches_duckdb(spark, duck, key):
    frame = QUERIES[key](spark, SF_DIR)
    result = duck.execute(CHECKS[key])
    columns = [d[0] for d in result.description]
    got = _canonical(frame.columns, [tuple(r) for r in frame.collect()])
    assert got == _canonical(columns, result.fetchall())
    assert got[1]


@pytest.mark.parametrize("key,step", [
    ("P2c", lambda t: steps._expanded(t, True, "inner", cancel=True)),
    ("P3c", lambda t: steps._expanded(t, False, "inner", cancel=True)),
    ("Q03", lambda t: counts._outer_churn(t, AS_OF, how="inner")),
])
def test_outer_variants_are_proven(spark, duck, key, step):
    """Inner joins in their place give other rows than the check."""
    frame = over_star(step)(spark, SF_DIR)
    result = duck.execute(CHECKS[key])
    columns = [d[0] for d in result.description]
    got = _canonical(frame.columns, [tuple(r) for r in frame.collect()])
    assert got[0] == sorted(columns) and got != _canonical(columns, result.fetchall())


@pytest.mark.parametrize("trap,where", [
    ("X14", "SELECT 1 FROM invoices WHERE charge IS NULL AND attempt_count = 0"),
    ("X14", "SELECT 1 FROM refunds JOIN invoices ON charge = refunded"),
    ("X26", "SELECT year(make_timestamp(from_s * 1000000)) FROM invoices GROUP BY 1 HAVING count(DISTINCT month(make_timestamp(from_s * 1000000))) > 1"),
    ("X31", "SELECT 1 FROM lines WHERE span <> 'year' AND amount % 100 <> 0"),
    ("X32", "SELECT 1 FROM lines WHERE span = 'year' AND day(line_start) > 28"),
    ("X44", "SELECT 1 FROM lines WHERE length(monthname(line_start)) < 9"),
    ("X49", "SELECT 1 FROM lines WHERE round((amount - coalesce(discounts[1], 0)) / 100) <> round_even((amount - coalesce(discounts[1], 0)) / 100, 0)"),
    ("X51", "SELECT 1 FROM lines WHERE amount < 3000000 AND amount % 100 <> 0"),
    ("X53", "SELECT 1 FROM lines WHERE quoted"),
    ("P1j", "SELECT 1 FROM lines GROUP BY json_id HAVING count(DISTINCT coalesce(discounts[1], 0)) > 1"),
    ("P2c", "SELECT 1 FROM lines LEFT JOIN products USING (product) WHERE product_name IS NULL AND span = 'year'"),
    ("P3c", "SELECT 1 FROM lines JOIN products USING (product) LEFT JOIN prices USING (product) WHERE cents IS NULL AND span <> 'year'"),
])
def test_the_traps_are_in_the_fixture(duck, trap, where):
    """Rows on which a naive translation of the step would differ."""
    assert trap in CHECKS
    assert duck.execute(statement([*STAR, REFUNDS], where)).fetchone()


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
