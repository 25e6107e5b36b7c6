"""Projections, filters, sets, subqueries, aggregates and ranks over the small firm."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import subqueries
from tablewright.operators.changes import delete_not_in
from tablewright.workloads import aggregation, expressions, ranking, selection
from tests.fixtures import company, firm, rows


@pytest.fixture(scope="module")
def t(spark):
    return firm(spark)


def ids(df):
    return [r[0] for r in rows(df, "emp_id")]


def test_projections(t):
    assert dict(rows(selection.case(t), "project_name", "budget_category")) == {
        "Harbour Survey": "Medium", "Ledger Rollout": "Large",
        "Orchard Drive": "Medium", "Archive Transfer": "Medium",
    }
    pay = {r.emp_name: r for r in selection.arithmetic(t).collect()}["Jorn Stell"]
    assert (str(pay.monthly_salary), str(pay.raise_amount)) == ("6250.00", "7500.000")


def test_filters(t):
    assert ids(selection.date_literal(t)) == [1, 2, 4, 5, 6]
    assert ids(selection.between(t)) == [2, 3, 4, 5, 6]
    assert ids(selection.null_tests(t)) == [2, 5]
    assert selection.never(t).columns == t.emp.columns and ids(selection.never(t)) == []


def test_functions(t):
    by_id = lambda df: [r[1] for r in rows(df)]
    assert by_id(expressions.coalesce(t))[4] == "No email provided"
    assert by_id(expressions.substring(t)) == ["jor", "san", "mbr", "emr", None, "lir"]
    assert by_id(expressions.concat(t))[4] == "Rorik Wend " and by_id(expressions.concat_operator(t))[4] is None


def test_aggregates(t):
    assert rows(aggregation.average_by_group(t)) == [
        ("BUILDING", 70000.0), ("FURNITURE", 56500.0), ("HOUSEHOLD", 60000.0),
    ]
    assert dict(rows(aggregation.join_sum(t))) == {
        "Harbour Survey": 215.5, "Archive Transfer": 80.0,
        "Orchard Drive": 135.5, "Ledger Rollout": 110.0,
    }
    assert rows(aggregation.global_(t)) == [(75000.0, 55000.0, 383000.0)]
    assert rows(aggregation.global_empty(t)) == [(None, None, 0)]


def test_sets(t):
    assert ids(selection.union(t)) == [1, 2, 4, 5, 6]
    assert ids(selection.intersect(t)) == [1, 5]
    assert ids(selection.except_(t)) == [4]


def test_subqueries(t):
    assert ids(selection.exists(t)) == [1, 2, 3, 5, 6]
    assert ids(selection.in_join(t)) == [1, 2, 5]
    assert ids(selection.above_any(t)) == [1, 2, 4, 5, 6]
    none = t.emp.filter(F.lit(False))
    assert ids(subqueries.above_any(t.emp, "salary", none, "salary")) == []


@pytest.mark.parametrize("values", [[], [1], [1, None], [None], [1, 2, 3]])
def test_not_in_follows_sql(spark, values):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x long")
    others = spark.createDataFrame([(v,) for v in values], "y long")
    df.createOrReplaceTempView("not_in_left")
    others.createOrReplaceTempView("not_in_right")
    want = rows(spark.sql("SELECT x FROM not_in_left WHERE x NOT IN (SELECT y FROM not_in_right)"))
    assert rows(subqueries.not_in(df, "x", others, "y")) == want
    kept = rows(delete_not_in(df, "x", others, "y"))
    assert sorted(want + kept, key=repr) == sorted(rows(df), key=repr)


def test_single_value_refuses_two(spark):
    df = spark.createDataFrame([(1,), (2,)], "k long")
    lookup = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d")], "key long, v string")
    assert rows(subqueries.single_value(df, "k", lookup, "key", "v", "v")) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="more than one row"):
        subqueries.single_value(df.union(df.limit(1).select(F.lit(3))), "k", lookup, "key", "v", "v").collect()


def test_rank_with_average(t):
    got = [
        (r.employee_name.split()[0], float(r.salary), r.avg_hours_worked and float(r.avg_hours_worked), r.salary_rank)
        for r in ranking.rank_with_average(t).orderBy("segment", F.desc("salary")).collect()
    ]
    assert got == [
        ("Jorn", 75000, 100.25, 1), ("Rorik", 70000, 110.0, 2), ("Sanna", 65000, 95.0, 3),
        ("Lira", 58000, 75.5, 1), ("Milo", 55000, 60.0, 2), ("Emra", 60000, None, 1),
    ]


def test_company_aggregates(spark):
    c = company(spark)
    assert rows(aggregation.having_average(c)) == [("Finance", 65000.0), ("HR", 60000.0), ("IT", 52500.0)]
    stats = {r.dept_name: tuple(map(float, r[2:])) for r in aggregation.dept_statistics_query(c).collect()}
    assert stats == {
        "IT": (2, 52500, 55000, 50000), "HR": (1, 60000, 60000, 60000),
        "Finance": (1, 65000, 65000, 65000), "Marketing": (0, 0, 0, 0),
    }
    assert rows(aggregation.over_view(c)) == [(4, 375000.0)]
    assert rows(ranking.top_row(c), "dept_name", "highest_paid_employee") == [
        ("Finance", "Sarah Williams"), ("HR", "Jane Doe"), ("IT", "Mike Johnson"), ("Marketing", None),
    ]
