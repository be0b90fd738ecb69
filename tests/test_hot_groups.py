"""Exactness when one key holds much of the data."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from subtally.operators.delinquency import months_per_customer, repeat_customers
from subtally.operators.grouping import (
    PIECES_PER_PARTITION,
    first_per_group,
    not_in,
    with_neighbours,
    with_pieces,
)


def _events(spark, seed=7, n=4000):
    """A third of all rows on one key, ties on the day, unknown days."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(400)}"
        second = None if rng.random() < 0.02 else rng.randrange(40 * 86400)
        data.append((key, second, i, rng.choice([None, rng.randrange(100)])))
    return data, spark.createDataFrame(data, "key string, s long, id long, value long")


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _pieces(spark):
    return PIECES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("seed", [7, 8])
def test_neighbours_match_brute_force(spark, seed):
    data, frame = _events(spark, seed)
    got = with_neighbours(
        frame.repartition(3), "key", ["s", "id"],
        lags={"before": "value", "id_before": "id"}, leads={"after": "value", "id_after": "id"},
    ).select("id", "before", "id_before", "after", "id_after").collect()
    expected = {}
    groups = {}
    for key, second, id, value in data:
        groups.setdefault(key, []).append((second is None, second or 0, id, value))
    for members in groups.values():
        members.sort(key=lambda m: m[:3])
        for i, (_, _, id, _) in enumerate(members):
            prev = members[i - 1] if i else (None,) * 4
            after = members[i + 1] if i + 1 < len(members) else (None,) * 4
            expected[id] = (prev[3], prev[2], after[3], after[2])
    assert {r.id: tuple(r)[1:] for r in got} == expected


@pytest.mark.parametrize("data", [
    [], [(None, None, 1, None)], [("a", 1, 1, 5)],
    [(None, 3, 1, 5), (None, None, 2, 6), ("a", None, 3, 7), ("a", None, 4, None)],
])
def test_neighbours_of_few_and_null_rows(spark, data):
    frame = spark.createDataFrame(data, "key string, s long, id long, value long")
    rows = with_neighbours(frame, "key", ["s", "id"], {"b": "id"}, {"a": "value"}).collect()
    got = sorted((r.id, r.b, r.a) for r in rows)
    assert got == {
        0: [], 1: [(data[0][2], None, None)] if data else [], 4: [(1, None, 6), (2, 1, None), (3, None, None), (4, 3, None)],
    }[len(data)]


def test_neighbours_with_equal_order_keys_stay_a_chain(spark):
    """Ties in the order may fall either way, but every row has one place in the chain."""
    frame = spark.range(200).select(
        F.lit("hot").alias("key"), F.lit(0).cast("timestamp").alias("at"), F.col("id").alias("v")
    )
    got = with_neighbours(frame, "key", ["at"], {"b": "v"}, {"a": "v"}).collect()
    after = {r.v: r.a for r in got}
    before = {r.v: r.b for r in got}
    assert sum(v is None for v in after.values()) == sum(v is None for v in before.values()) == 1
    assert all(before[a] == v for v, a in after.items() if a is not None)


def test_one_customer_day_is_many_pieces(spark):
    """Nine tenths of all rows on one day of one key: no piece holds much of them."""
    rows = 20_000
    frame = spark.range(rows).select(
        F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.when(F.col("id") % 3 != 0, 86400 * 5).alias("s"), F.xxhash64("id").alias("id"), "id",
    ).toDF("key", "s", "place", "value")
    sizes = with_pieces(frame, ["key", "s", "place"]).groupBy("__piece").count().collect()
    assert len(sizes) >= 0.9 * _pieces(spark)
    assert max(r["count"] for r in sizes) <= 4 * rows / _pieces(spark)
    got = with_neighbours(frame, "key", ["s", "place"], {"b": "place"}, {}).filter("key = 'hot'").collect()
    ordered = sorted(got, key=lambda r: (r.s is None, r.place))
    assert [r.b for r in ordered] == [None, *[r.place for r in ordered[:-1]]]


def test_pieces_follow_the_order(spark):
    _, frame = _events(spark)
    rows = with_pieces(frame, ["key", "s", "id"]).collect()
    ordered = sorted(rows, key=lambda r: (r.key, r.s is None, r.s or 0, r.id))
    numbers = [r["__piece"] for r in ordered]
    assert numbers == sorted(numbers)


def test_neighbours_shuffle_rows_once_and_stitch_edges(spark):
    """All rows go through one exchange, read twice; only two rows a piece go through more."""
    _, frame = _events(spark)
    cached = frame.repartition(3)
    result = with_neighbours(cached, "key", ["s", "id"], {"b": "value"}, {"a": "value"})
    result.collect()
    # Plans of subqueries, which stand inside, are indented.
    final = _plan(result).split("\n+- == Initial Plan ==")[0]
    wide = [x for x in final.split("\n") if "Exchange hashpartitioning(__piece" in x and "Reused" not in x]
    assert len(wide) == 1
    assert any("ReusedExchange" in x and "hashpartitioning(__piece" in x for x in final.split("\n"))
    assert final.count("Exchange SinglePartition") == 1
    seams = [x for x in final.split("\n") if "Window [lag(tail" in x]
    assert len(seams) == 1
    assert "(__first" in final or "Filter (isnull" in final


def test_first_per_group_is_limited_before_the_shuffle(spark):
    data, frame = _events(spark)
    top = first_per_group(frame, ["key"], [F.desc_nulls_first("s"), F.asc("id")])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("1, Partial")
    best = {}
    for key, second, id, _ in data:
        rank = (second is not None, -(second or 0), id)
        best[key] = min(best.get(key, rank), rank)
    assert {r.key: r.id for r in top.collect()} == {k: r[2] for k, r in best.items()}


def test_repeat_customers_equal_counted_months(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", "c", None]) if i % 3 else f"x{i}",
             rng.choice([2023, 2024]), rng.choice([1, 2])) for i in range(60)]
    data += [("d", None, None), ("d", 2023, 1), ("e", None, None)]
    months = spark.createDataFrame(data, "customer string, year int, month int")
    counted = months_per_customer(months).filter("customer_count > 1").select("customer")
    assert {r[0] for r in repeat_customers(months).collect()} == {r[0] for r in counted.collect()}


@pytest.mark.parametrize("listed", [[], ["a"], ["a", "a", "b"], [None], ["a", None], ["zz"]])
def test_not_in_is_sql_not_in(spark, listed):
    """NULL left, NULL right and an empty right side, against the engine's own NOT IN."""
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "k string, n int")
    values = spark.createDataFrame([(v,) for v in listed], "v string")
    expected = spark.sql(
        "SELECT n FROM {f} WHERE k NOT IN (SELECT v FROM {v})", f=frame, v=values
    ).collect()
    assert sorted(not_in(frame, "k", values).select("n").collect()) == sorted(expected)


def test_not_in_reads_its_right_side_for_one_aggregate(spark):
    frame = spark.range(100).select(F.col("id").alias("k"))
    values = spark.range(50).select((F.col("id") * 2).alias("v"))
    result = not_in(frame, "k", values)
    result.collect()
    initial = _plan(result).split("\n+- == Initial Plan ==")[1]
    assert len(set(re.findall(r"Subquery (subquery#\d+)", initial))) == 1
    assert "BroadcastNestedLoopJoin" not in _plan(result) and "LeftAnti" in _plan(result)


def test_many_partitions_cost_no_planning_time(spark):
    """The optimizer does not expand the binary search, whose depth grows with the partitions."""
    _, frame = _events(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    try:
        start = time.perf_counter()
        plan = with_neighbours(frame, "key", ["s", "id"], {"b": "value"}, {"a": "value"})
        plan._jdf.queryExecution().executedPlan()
        assert time.perf_counter() - start < 20  # about a second; minutes when expanded
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
