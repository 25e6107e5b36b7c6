"""Every registered query against its SQL, and the shape of every plan."""

import re

import pytest

import __spark_entry__ as entry
from tablewright.workloads import QUERIES, SQL
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_equals_sql(spark, con, key):
    assert differences(QUERIES[key](spark, SMALL), con, SQL[key]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 25


def test_plans_have_no_products_sorted_groups_or_python(spark):
    """Also with broadcasts off, as they are when the tables are large."""
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for key, plan in QUERIES.items():
                text = plan(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
                assert not re.search("NestedLoop|CartesianProduct|EvalPython|InPandas|SortAggregate", text), key
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(spark, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return QUERIES[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_spread(spark):
    text = plan_of(spark, "join_21_self_left")
    assert re.search(r"hashpartitioning\(e_manager_id#\d+L, __salt#\d+L", text)


def test_children_are_summed_before_the_join(spark):
    text = plan_of(spark, "agg_10_fan_out")
    for child in ("customer", "supplier"):
        above = text[: text.index(f"{child}.parquet")]
        assert above.rindex("partial_count") > above.rindex("SortMergeJoin")


def test_queries_leave_no_table_or_view(spark):
    for key in QUERIES:
        if key.startswith(("view_", "src_25")):
            QUERIES[key](spark, SMALL)
    made = ("dept_", "employee", "project_", "high_", "top_", "temp_", "it_", "hr_", "finance_")
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith(made)]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan_of(spark, "dq_07_domain")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text
    text = plan_of(spark, "flt_03_like")
    assert re.search(r"PushedFilters: \[[^\]]*StringStartsWith\(c_mktsegment,B\)", text)
