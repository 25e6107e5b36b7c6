"""The functions themselves: Spark splits the hot side although the key set is too large to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes, joins, subqueries
from tablewright.sources.tables import Tables
from tablewright.workloads.changes import lines_lost
from tests.test_skew import N, final_plan, hot, people, skew  # noqa: F401


def many(spark):
    """Each key several times, so that the key set has to be grouped."""
    return people(spark).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5))))


CASES = {
    "matched": lambda h, p, m: joins.matched(h, m, {"customer": "person"}),
    "unmatched": lambda h, p, m: joins.unmatched(h, m, {"customer": "person"}),
    "cascade": lambda h, p, m: changes.cascade(h, "customer", m, "person")[1],
    "set_null": lambda h, p, m: changes.set_null(h, "customer", m, "person"),
    "not_in": lambda h, p, m: subqueries.not_in(h, "customer", m, "person"),
    "delete_not_in": lambda h, p, m: changes.delete_not_in(h, "customer", m, "person"),
    "single_value": lambda h, p, m: subqueries.single_value(h, "customer", p, "person", "name", "found"),
    "update_from_lookup": lambda h, p, m: changes.update_from_lookup(h, "customer", p.withColumnRenamed("person", "customer"), "note", "name"),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_spark_splits_the_hot_side_of(spark, hot, skew, name):  # noqa: F811
    df = CASES[name](hot, people(spark), many(spark))
    if name == "update_from_lookup":
        df = df.select("customer", "note")
    assert re.search(r"skew=true", final_plan(df))


def test_not_in_reads_its_set_once(spark, hot, tmp_path):  # noqa: F811
    path = str(tmp_path / "set")
    many(spark).write.parquet(path)
    m = spark.read.parquet(path)
    plan = final_plan(subqueries.not_in(hot, "customer", m, "person"))
    final = plan[: plan.find("Initial Plan")] if "Initial Plan" in plan else plan
    assert plan.count("ReusedExchange") >= 1, final


def test_not_in_with_hot_keys(spark, hot, skew):  # noqa: F811
    known = hot.filter("customer < 990").count()
    null = hot.filter("customer IS NULL").count()
    assert subqueries.not_in(hot, "customer", many(spark), "person").count() == N - known - null
    with_null = many(spark).select("person").union(spark.range(1).selectExpr("CAST(NULL AS BIGINT)"))
    assert subqueries.not_in(hot, "customer", with_null, "person").count() == 0
    assert subqueries.not_in(hot, "customer", many(spark).filter("person < 0"), "person").count() == N


def test_a_repeated_key_of_a_lookup_still_fails(spark, hot):  # noqa: F811
    with pytest.raises(Exception, match="more than one row"):
        subqueries.single_value(hot, "customer", many(spark), "person", "name", "found").collect()


def shuffled_rows(df):
    """What was written to the shuffles of the plan that ran."""
    df.collect()
    plan, total = [df._jdf.queryExecution().executedPlan()], 0
    while plan:
        node = plan.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plan.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            plan.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            plan += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_bloom_filter_goes_before_the_shuffle(spark):
    """Few orders go: most lines are kept from the shuffle, and the result is the same."""
    t = Tables(spark, "/root/testdata/sf0.01")
    gone = t.scan("orders").filter("o_orderstatus = 'P' AND o_totalprice > 200000")
    found = {}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for least in ("0", "1000g"):
        settings["spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"] = least
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = lines_lost(t.scan("lineitem"), gone)
        found[least] = (sorted(map(tuple, df.collect())), shuffled_rows(df), "might_contain" in df._jdf.queryExecution().optimizedPlan().toString())
    for k in settings:
        spark.conf.unset(k)
    with_filter, without = found["0"], found["1000g"]
    assert with_filter[0] == without[0] and with_filter[2] and not without[2]
    assert with_filter[1] < without[1] / 2
