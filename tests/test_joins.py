"""Joins of the small company, and agreement between forms that must be equal."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.operators import joins
from tablewright.operators.aggregates import fan_out_totals
from tablewright.workloads import joining
from tests.fixtures import company, rows


@pytest.fixture(scope="module")
def t(spark):
    return company(spark)


JOHN, JANE, MIKE, SARAH, TOM = "John Smith", "Jane Doe", "Mike Johnson", "Sarah Williams", "Tom Brown"
MATCHED = sorted([(JOHN, "IT"), (JANE, "HR"), (MIKE, "IT"), (SARAH, "Finance")])


def test_product(t):
    pay = sum(r.salary for r in t.emp.collect())
    assert {(r.pairs, r.total) for r in joining._product(t).collect()} == {(5, pay)}
    assert joining._product(t).count() == 4
    assert joining.pair_count(t).first()[0] == 25
    depts = t.dept.select("dept_id")
    assert joins.product_totals(depts.limit(0), t.emp, "salary").count() == 0
    assert joins.product_totals(depts, t.emp.limit(0), "salary").count() == 0


@pytest.mark.parametrize("plan", [joining.inner_on, joining.inner_using, joining.natural])
def test_inner(t, plan):
    assert rows(plan(t), "emp_name", "dept_name") == MATCHED


def test_inner_on_keeps_person_keys_and_place(t):
    places = {r.dept_id: r.location for r in t.dept.collect()}
    people = [r for r in t.emp.collect() if r.dept_id in places]
    want = sorted((r.emp_id, r.emp_name, r.dept_id, r.dept_id, places[r.dept_id]) for r in people)
    assert rows(joining.inner_on(t), "emp_id", "emp_name", "left_key", "right_key", "location") == want and len(want) == 4


def test_natural_needs_a_common_column(t):
    with pytest.raises(ValueError):
        joins.natural_join(t.emp.select("emp_name"), t.dept)


def test_fan_out_size(t):
    met = rows(joining.fan_out_size(t), "emp_id", "projects_met")
    assert met == [(1, 2), (2, 1), (3, 2), (4, 1)]


@pytest.mark.parametrize("plan", [joining.left_on, joining.left_using])
def test_left(t, plan):
    assert rows(plan(t), "emp_name", "dept_name") == sorted(
        [*MATCHED, (TOM, None)], key=lambda r: [(v is None, v) for v in r]
    )


def test_unmatched(t):
    assert rows(joining.unmatched_left(t)) == [(TOM, None)]
    assert rows(joining.unmatched_right(t)) == [("Marketing", "Building D")]


def test_left_count_is_ordered(t):
    got = [tuple(r) for r in joining.left_count(t).collect()]
    assert got == [("IT", 2), ("HR", 1), ("Finance", 1), ("Marketing", 0)]


@pytest.mark.parametrize("plan", [joining.right, joining.right_as_left])
def test_right(t, plan):
    assert rows(plan(t)) == [*sorted(MATCHED), (None, "Marketing")]


def test_full(t):
    assert len(rows(joining.full(t))) == 6
    assert len(rows(joining.full_projects(t))) == 6
    assert (None, None, 104, "Marketing") in rows(joining.full(t))
    assert (TOM, None, None, None) in rows(joining.full(t))


def test_orphans(t):
    assert rows(joining.orphans(t)) == [
        ("Department without employees", None, "Marketing"),
        ("Employee without department", TOM, None),
    ]


def test_filter_place(t):
    on = rows(joining.filter_in_on(t), "emp_name", "dept_name")
    assert len(on) == 5 and [r for r in on if r[1]] == [(JOHN, "IT"), (MIKE, "IT")]
    for plan in (joining.filter_in_where, joining.inner_filter_on, joining.inner_filter_where):
        assert rows(plan(t), "emp_name", "dept_name") == [(JOHN, "IT"), (MIKE, "IT")]


def test_two_children(t):
    got = [(r.dept_name, r.emp_name, r.projects) for r in joining.two_children(t).collect()]
    assert got == [("Finance", SARAH, 1), ("HR", JANE, 1), ("IT", JOHN, 2), ("IT", MIKE, 2), ("Marketing", None, 0)]
    totals = fan_out_totals(t.dept, "dept_id", t.emp, "salary", t.proj, "budget")
    assert dict(rows(totals, "dept_name", "joined_rows")) == {"IT": 4, "HR": 1, "Finance": 1, "Marketing": 1}


def test_self_joins(t):
    bosses = [(JANE, MIKE), (JOHN, MIKE), (SARAH, MIKE), (TOM, MIKE), (MIKE, None)]
    assert sorted(rows(joining.self_left(t)), key=repr) == sorted(bosses, key=repr)
    two = rows(joining.two_levels(t))
    assert len(two) == 5 and all(r[2] is None for r in two)


def test_pairs(t):
    assert rows(joining.pairs_per_department(t)) == [("IT", 1)]
    assert rows(joining.pairs_per_employee(t), "emp_name", "later_colleagues") == sorted(
        [(JOHN, 1), (MIKE, 0), (JANE, 0), (SARAH, 0)]
    )


def test_derived_and_union(t):
    assert rows(joining.derived_having(t), "emp_name", "dept_name") == [(JOHN, "IT"), (MIKE, "IT")]
    named = t.emp.withColumn("segment", t.emp.emp_name)
    t2 = type(t)(**{**vars(t), "emp": named})
    assert len(rows(joining.full_by_union(t2))) == 6
    assert rows(joining.mixed(t), "project_id", "team", "top_salary") == [
        (1, 2, 55000.0), (2, 1, 60000.0), (3, 1, 65000.0), (4, 2, 55000.0),
    ]


def test_outer_helpers_equal_spark_outer_joins(t):
    e = t.emp.withColumnRenamed("dept_id", "emp_dept").select("emp_name", "emp_dept")
    for how, helper in (("right", joins.right_outer), ("full", joins.full_outer)):
        plain = e.join(t.dept, e.emp_dept == t.dept.dept_id, how)
        for small in (True, False):
            assert rows(helper(e, t.dept, "emp_dept", "dept_id", small), *plain.columns) == rows(plain)


def test_self_match(t):
    bosses = joins.matched(t.emp, t.emp, {"emp_id": "manager_id"})
    assert rows(bosses, "emp_name") == [(MIKE,)]
    assert joins.unmatched(t.emp, t.emp, {"emp_id": "manager_id"}).count() == 4


keys = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keys, right=keys)
def test_outer_joins_with_repeats_and_nulls(spark, left, right):
    a = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "x int, a int")
    b = spark.createDataFrame([(i, k) for i, k in enumerate(right)], "y int, b int")
    for how, helper in (("right", joins.right_outer), ("full", joins.full_outer)):
        want = a.join(b, a.a == b.b, how)
        assert sorted(rows(helper(a, b, "a", "b", True), *want.columns), key=repr) == sorted(rows(want), key=repr)
    want = a.join(b, a.a == b.b, "left")
    got = joins.left_outer(a, b, "a", "b", spread="x")
    assert sorted(rows(got, *want.columns), key=repr) == sorted(rows(want), key=repr)
