"""One key with a third of all rows: results stay whole and Spark splits the hot side."""

import re

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes, joins, quality
from tablewright.sources.spec import ForeignKey
from tests.fixtures import rows

# as on a cluster, but with thresholds that a small table can cross
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    "spark.sql.files.maxPartitionBytes": "256KB",
}
N = 600_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Orders of 1000 customers; customer 7 has a third of them, a ninth have none."""
    path = str(tmp_path_factory.mktemp("skew") / "orders")
    customer = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 9 = 1 THEN NULL ELSE id % 1000 END AS customer"
    spark.range(N, numPartitions=8).selectExpr("id", customer, "md5(string(id)) AS note").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def skew(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def people(spark):
    return spark.range(0, 990).selectExpr("id AS person", "'p' || id AS name")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spark_splits_the_hot_side(spark, hot, skew, how):
    joined = hot.join(people(spark), F.col("customer") == F.col("person"), how)
    assert re.search(r"skew=true", final_plan(joined))


def test_counts_with_a_hot_key(spark, hot, skew):
    p = people(spark)
    known = hot.filter("customer < 990").count()
    null = hot.filter("customer IS NULL").count()
    assert joins.matched(hot, p, {"customer": "person"}).count() == known
    assert joins.unmatched(hot, p, {"customer": "person"}).count() == N - known
    assert joins.left_outer(hot, p, "customer", "person", spread="id").count() == N
    kept, lost = changes.cascade(hot, "customer", p.filter("person = 7"), "person")
    assert (kept.count(), lost.count()) == (N - hot.filter("customer = 7").count(), hot.filter("customer = 7").count())
    after = changes.set_null(hot, "customer", p, "person")
    assert after.count() == N and after.filter("customer IS NULL").count() == known + null


def test_hot_values_are_one_row_before_the_shuffle(spark, hot):
    fk = ForeignKey(("customer",), "people", ("person",))
    lost = quality.dangling(hot, fk, people(spark).filter("person <> 7"), "fk")
    assert len(rows(lost)) == 11  # customer 7 and customers 990 to 999
    text = lost._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(customer")
