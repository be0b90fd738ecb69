"""Results on star tables where one customer and one order hold a third of the rows."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.test_oracle import _canonical

SF_DIR = "/root/testdata/sf0.001"
KEYS = ["Q02", "Q03", "Q04", "Q05", "Q13", "Q20", "Q34"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the orders to one customer, a third of the lines to one order."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    changed = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 10 ELSE o_custkey END AS o_custkey)",
        # The hot order keeps the line numbers; what repeats then differs in its supplier.
        "lineitem": """
            SELECT * REPLACE (
              CASE WHEN n % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
              CASE WHEN n % 3 = 0 THEN n ELSE l_suppkey END AS l_suppkey)""",
        "customer": "SELECT *",
        "part": "SELECT *",
    }
    for table, select in changed.items():
        source = f"'{SF_DIR}/{table}.parquet'"
        if table == "lineitem":
            source = f"(SELECT *, row_number() OVER () AS n FROM {source})"
            select = select.replace("SELECT *", "SELECT * EXCLUDE (n)", 1)
        target = f"{folder}/{table}.parquet"
        con.execute(f"COPY ({select} FROM {source}) TO '{target}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS FROM '{target}'")
    return str(folder), con


@pytest.fixture
def splitting(spark):
    """Every partition above a few kilobytes counts as skewed, and nothing is broadcast."""
    eager = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in eager}
    for key, value in eager.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("key", KEYS)
def test_skewed_tables_match_duckdb(splitting, skewed, key):
    folder, con = skewed
    frame = entry_module.queries()[key](splitting, folder)
    got = _canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(entry_module.oracle_sql()[key])
    assert got == _canonical([d[0] for d in result.description], result.fetchall())
