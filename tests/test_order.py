"""Numbers and ranks in the order of text, dates and several columns; joins of bucketed tables."""

import random

import pytest
from pyspark.sql import functions as F
from tests.compare import connect, differences
from tests.fixtures import rows

from tablewright.plans.order import number_rows, rank_by, sum_before_in_order
from tablewright.sources import ingest
from tablewright.sources.stored import StoredTable
from tablewright.sources.tables import Tables
from tablewright.workloads.changes import cascade_in_buckets
from tablewright.workloads.joining import lines_of_orders


def people(spark, n=5000):
    """A third of all rows in one group; names that tie; NULL names and groups."""
    rng = random.Random(2)
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else None if i % 97 == 0 else f"g{rng.randrange(40)}"
        name = None if i % 31 == 0 else rng.choice("äzÀabc") * rng.randint(0, 3) + str(rng.randrange(400))
        data.append((i, group, name))
    return data, spark.createDataFrame(data, "id long, grp string, name string").repartition(7)


def test_numbers_in_the_order_of_names(spark):
    data, df = people(spark)
    got = number_rows(df, [F.col("name").asc_nulls_first(), F.col("id")], "n", 10).collect()
    order = sorted(data, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0]))
    assert {r["id"]: r["n"] for r in got} == {r[0]: 10 + i for i, r in enumerate(order)}


def test_ranks_by_text_with_a_hot_group(spark):
    data, df = people(spark)
    got = {r["id"]: r["r"] for r in rank_by(df, "grp", "name", "r").collect()}
    by = {}
    for _, g, s in data:
        by.setdefault(g, []).append((s or "").encode() if s is not None else None)
    want = {i: 1 if g is None or s is None else 1 + sum(x is not None and x > s.encode() for x in by[g]) for i, g, s in data}
    assert got == want


def test_totals_in_the_order_of_two_columns(spark):
    df = spark.createDataFrame([("a", 1, "x", 5), ("a", 1, "y", 7), ("a", 2, "a", 1), ("b", 0, "q", 2)], "g string, k int, s string, w int")
    got = sum_before_in_order(df, ["g"], [F.col("k").desc(), F.col("s")], "w", "t").select("g", "s", "t")
    assert sorted(rows(got)) == [("a", "a", 0), ("a", "x", 1), ("a", "y", 6), ("b", "q", 0)]
    assert sum_before_in_order(df.filter("k > 9"), ["g"], [F.col("k")], "w", "t").count() == 0


def test_keys_for_names(spark):
    new = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "name string")
    got = sorted(rows(ingest.assign_keys(new, "name", "id", 5).select("id", "name")))
    assert got == [(5, None), (6, "a"), (7, "a"), (8, "b")]


@pytest.fixture
def bucketed(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    out = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        stored = StoredTable.fresh(spark, name)
        stored.write(t.scan(name), bucket_by=(8, key))
        out.append(stored.read())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield out
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_are_joined_where_they_lie(spark, bucketed):
    for df in (lines_of_orders(*bucketed), cascade_in_buckets(*bucketed)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    con = connect("/root/testdata/sf0.001")
    sql = "SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"
    assert differences(cascade_in_buckets(*bucketed), con, sql) == []
