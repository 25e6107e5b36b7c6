"""Updates and deletes; each query returns the whole table after the change."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import rounded_quotient, three_bands
from tablewright.operators import changes, joins, quality, subqueries
from tablewright.operators.aggregates import per_key
from tablewright.plans.views import TableView
from tablewright.sources.ingest import literal_rows
from tablewright.sources.spec import Check, ForeignKey, SetDefault, alter, references, table
from tablewright.sources.stored import StoredTable
from tablewright.sources.tables import Tables, day
from tablewright.workloads import fixed
from tablewright.workloads.registry import query

STAFF = table(
    "staff",
    "emp_id bigserial, first_name varchar(50), last_name varchar(50), department varchar(50),"
    "salary int, hire_date date, status varchar(20) = 'ACTIVE'",
    primary_key=("emp_id",),
)
EMP = table(
    "emp",
    "emp_id bigint, emp_name varchar(50), segment varchar(20), dept_id int, salary numeric(10,2),"
    "manager_id bigint, email varchar(100), hire_date date",
    primary_key=("emp_id",),
)


def literal(value: str):
    """A decimal literal, so that products stay exact."""
    return F.expr(value)


@query(
    "dml_01_update_all",
    "SELECT * REPLACE (CAST(ROUND(salary * 1.10) AS INTEGER) AS salary) FROM staff",
    "staff",
)
def update_all(t: Tables) -> DataFrame:
    return changes.update(t.staff, {"salary": F.col("salary") * literal("1.10")})


@query(
    "dml_02_update_where",
    """SELECT * REPLACE (CASE WHEN salary > 60000 AND hire_date < '2020-01-01' THEN 'Senior'
         ELSE status END AS status) FROM staff""",
    "staff",
)
def update_where(t: Tables) -> DataFrame:
    where = (F.col("salary") > 60000) & (F.col("hire_date") < day("2020-01-01"))
    return changes.update(t.staff, {"status": F.lit("Senior")}, where)


@query(
    "dml_02_update_add",
    """SELECT * REPLACE (CASE WHEN department = 'BUILDING' THEN salary + 5000 ELSE salary END AS salary)
       FROM staff""",
    "staff",
)
def update_add(t: Tables) -> DataFrame:
    return changes.update(t.staff, {"salary": F.col("salary") + 5000}, F.col("department") == "BUILDING")


@query(
    "dml_03_update_columns",
    """SELECT * REPLACE (
         CASE WHEN department = 'FURNITURE' THEN CAST(ROUND(salary * 1.15) AS INTEGER) ELSE salary END AS salary,
         CASE WHEN department = 'FURNITURE' THEN 'Promoted' ELSE status END AS status) FROM staff""",
    "staff",
)
def update_columns(t: Tables) -> DataFrame:
    values = {"salary": F.col("salary") * literal("1.15"), "status": F.lit("Promoted")}
    return changes.update(t.staff, values, F.col("department") == "FURNITURE")


@query(
    "dml_04_update_case",
    """SELECT * REPLACE (CASE WHEN salary > 80000 THEN 'Management'
         WHEN salary BETWEEN 50000 AND 80000 THEN 'Senior' ELSE 'Junior' END AS department) FROM staff""",
    "staff",
)
def update_case(t: Tables) -> DataFrame:
    return changes.update(t.staff, {"department": three_bands("salary", fixed.STAFF_BANDS)})


@query(
    "dml_05_update_default",
    "SELECT * REPLACE (CASE WHEN status = 'Inactive' THEN 'General' ELSE department END AS department) FROM staff",
    "staff",
)
def update_default(t: Tables) -> DataFrame:
    staff, spec = alter(t.staff, STAFF, SetDefault("department", "General"))
    return changes.update_to_default(staff, spec, "department", F.col("status") == "Inactive")


@query(
    "dml_06_update_null",
    "SELECT * REPLACE (COALESCE(department, 'Unassigned') AS department) FROM staff",
    "staff",
)
def update_null(t: Tables) -> DataFrame:
    return changes.update(t.staff, {"department": F.lit(fixed.UNASSIGNED)}, F.col("department").isNull())


@query(
    "dml_07_update_in_list",
    """SELECT * REPLACE (CASE WHEN department IN ('BUILDING', 'MACHINERY')
         THEN CAST(ROUND(salary * 1.10) AS INTEGER) ELSE salary END AS salary) FROM staff""",
    "staff",
)
def update_in_list(t: Tables) -> DataFrame:
    raised = {"salary": F.col("salary") * literal("1.10")}
    return changes.update(t.staff, raised, F.col("department").isin("BUILDING", "MACHINERY"))


@query(
    "dml_08_update_by_key",
    """SELECT * REPLACE (CASE emp_id WHEN 11 THEN 3 WHEN 12 THEN 3 WHEN 13 THEN NULL
         WHEN 14 THEN 3 WHEN 15 THEN 3 ELSE manager_id END AS manager_id) FROM emp""",
    "emp",
)
def update_by_key(t: Tables) -> DataFrame:
    spec = table("news", "emp_id bigint, manager_id bigint")
    news = literal_rows(t.spark, spec, [(11, 3), (12, 3), (13, None), (14, 3), (15, 3)])
    return changes.update_by_key(t.emp, "emp_id", news, "manager_id")


@query(
    "dml_09_update_from_aggregate",
    """SELECT u.* REPLACE ((SELECT CAST((24 * SUM(CAST(s.salary AS HUGEINT)) + 10 * COUNT(s.salary))
           // (20 * COUNT(s.salary)) AS INTEGER)
         FROM staff s WHERE s.department = u.dept_name) AS budget) FROM unit u""",
    "staff unit",
)
def update_from_aggregate(t: Tables) -> DataFrame:
    # average * 1.20, rounded once on assignment to the INTEGER column
    mean = rounded_quotient(F.sum("salary") * 12, F.count("salary") * 10)
    pay = per_key(t.staff, "department", new=mean).withColumnRenamed("department", "dept_name")
    return changes.update_from_lookup(t.unit, "dept_name", pay, "budget", "new")


@query(
    "dml_10_update_from_lookup",
    """SELECT s.* REPLACE (CAST(ROUND(CASE WHEN (SELECT budget FROM unit u WHERE u.dept_name = s.department)
         > 100000 THEN s.salary * 1.10 ELSE s.salary * 1.05 END) AS INTEGER) AS salary) FROM staff s""",
    "staff unit",
)
def update_from_lookup(t: Tables) -> DataFrame:
    known = subqueries.single_value(t.staff, "department", t.unit, "dept_name", "budget", "budget")
    raised = F.when(F.col("budget") > fixed.RICH_UNIT, F.col("salary") * literal("1.10")).otherwise(
        F.col("salary") * literal("1.05")
    )
    return changes.update(known, {"salary": raised}).drop("budget")


@query(
    "dml_11_update_by_count",
    """SELECT p.* REPLACE (CASE WHEN p.budget > 50000
         AND (SELECT COUNT(*) FROM emp e WHERE e.dept_id = p.dept_id) > 3
         THEN p.end_date + 30 ELSE p.end_date END AS end_date) FROM proj p""",
    "emp proj",
)
def update_by_count(t: Tables) -> DataFrame:
    counts = per_key(t.emp, "dept_id", n=F.count("*"))
    counted = t.proj.join(counts, "dept_id", "left")
    where = (F.col("budget") > 50000) & (F.coalesce("n", F.lit(0)) > 3)
    return changes.update(counted, {"end_date": F.date_add("end_date", 30)}, where).select(t.proj.columns)


def _salaries(t: Tables, where=None, checked: bool = False) -> TableView:
    """Names, departments and salaries of the employees, over a stored copy."""
    stored = StoredTable.fresh(t.spark, "emp")
    stored.write(t.emp)
    return TableView(stored, EMP, ["emp_id", "emp_name", "dept_id", "salary"], where, checked)


def _hired(t: Tables, *people: tuple) -> DataFrame:
    visible = table("view", "emp_id bigint, emp_name varchar(50), dept_id int, salary numeric(10,2)")
    return literal_rows(t.spark, visible, people)


def _refused(write) -> bool:
    try:
        write()
    except quality.IntegrityError:
        return True
    return False


@query(
    "dml_12_update_through_view",
    """SELECT * REPLACE (CASE WHEN dept_id = 1 AND salary < 30000 THEN CAST(salary + 2000 AS DECIMAL(10,2))
         ELSE salary END AS salary) FROM emp""",
    "emp",
)
def update_through_view(t: Tables) -> DataFrame:
    """Rows of other departments are not shown, so the same condition leaves them alone."""
    view = _salaries(t, F.col("dept_id") == 1)
    view.update({"salary": F.col("salary") + 2000}, F.col("salary") < 30000)
    return view.stored.read()


@query(
    "dml_13_insert_through_view",
    """SELECT * FROM emp UNION ALL
       SELECT -1, 'Newcomer', NULL, 2, CAST(41500.50 AS DECIMAL(10,2)), NULL, NULL, NULL""",
    "emp",
)
def insert_through_view(t: Tables) -> DataFrame:
    view = _salaries(t)
    view.insert(_hired(t, (-1, "Newcomer", 2, "41500.50")))
    return view.stored.read()


@query(
    "dml_13_insert_through_checked_view",
    """SELECT 2 AS refused, * FROM emp UNION ALL
       SELECT 2, -1, 'Newcomer', NULL, 1, CAST(41500.50 AS DECIMAL(10,2)), NULL, NULL, NULL""",
    "emp",
)
def insert_through_checked_view(t: Tables) -> DataFrame:
    """A row of another department, and one of none, are refused; one of the view's is not."""
    view = _salaries(t, F.col("dept_id") == 1, checked=True)
    outside = [(-2, "Elsewhere", 2, 0), (-3, "Nowhere", None, 0)]
    refused = sum(_refused(lambda: view.insert(_hired(t, row))) for row in outside)
    view.insert(_hired(t, (-1, "Newcomer", 1, "41500.50")))
    return view.stored.read().select(F.lit(refused).alias("refused"), "*")


@query(
    "dml_13_insert_under_rules",
    """SELECT 5 AS refused, * FROM emp UNION ALL
       SELECT 5, -1, 'Newcomer', 'AUTO', 1, CAST(41500.50 AS DECIMAL(10,2)), 7, 'new@x.org', NULL""",
    "emp",
)
def insert_under_rules(t: Tables) -> DataFrame:
    """Of six inserts five break a rule, also together with a sound row, and leave no trace."""
    dept = table("dept", "dept_id int", primary_key=("dept_id",))
    own = ForeignKey(("manager_id",), "emp", ("emp_id",))
    spec = replace(
        EMP, unique=(("email",),), checks=(Check("salary", "salary >= 0"),), foreign_keys=(references("dept_id", dept), own)
    )
    stored = StoredTable.fresh(t.spark, "emp")
    stored.write(t.emp)
    columns = ["emp_id", "emp_name", "segment", "dept_id", "salary", "manager_id", "email"]
    sound = (-1, "Newcomer", "AUTO", 1, "41500.50", 7, "new@x.org")
    unsound = [
        [(1, "Key taken", "AUTO", 1, 1, 7, "b@x.org")],
        [(-2, "Below zero", "AUTO", 1, -1, 7, "b@x.org")],
        [(-2, "No such department", "AUTO", 99, 1, 7, "b@x.org")],
        [(-2, "No such manager", "AUTO", 1, 1, -7, "b@x.org")],
        [sound, (-2, "Same address", "AUTO", 1, 1, 7, "new@x.org")],
    ]

    def add(rows: list[tuple]) -> None:
        changes.insert(stored, literal_rows(t.spark, spec, rows, columns), spec, {"dept": t.dept})

    refused = sum(_refused(lambda: add(rows)) for rows in unsound)
    add([sound])
    return stored.read().select(F.lit(refused).alias("refused"), "*")


UNDER_RULES = replace(
    EMP,
    unique=(("email",),),
    checks=(Check("salary", "salary >= 0"),),
    foreign_keys=(ForeignKey(("dept_id",), "dept", ("dept_id",)), ForeignKey(("manager_id",), "emp", ("emp_id",))),
)


@query(
    "dml_08_update_under_rules",
    """SELECT 7 AS refused, * REPLACE (
         CASE WHEN emp_id = 12 THEN -12 ELSE emp_id END AS emp_id,
         CASE WHEN emp_id = 12 THEN 'moved@x.org' ELSE email END AS email,
         CASE WHEN manager_id = 12 THEN -12 ELSE manager_id END AS manager_id,
         CASE WHEN emp_id = 21 THEN 3 ELSE dept_id END AS dept_id)
       FROM emp""",
    "emp dept",
)
def update_under_rules(t: Tables) -> DataFrame:
    """Of ten updates seven break a rule and leave no trace."""
    stored = StoredTable.fresh(t.spark, "emp")
    stored.write(t.emp)
    key, boss = F.col("emp_id"), F.col("manager_id")
    parents = {"dept": t.dept}

    def change(values: dict, where) -> None:
        changes.update_stored(stored, values, where, UNDER_RULES, parents)

    unsound = [
        ({"emp_id": F.lit(1)}, key == 21),  # a key that another row has
        ({"emp_id": F.lit(-5)}, key.isin(21, 22)),  # one key for two rows
        ({"salary": F.lit(-1)}, key == 21),
        ({"dept_id": F.lit(99)}, key == 21),
        ({"manager_id": F.lit(-7)}, key == 21),
        ({"email": F.lit("same@x.org")}, key.isin(21, 23)),
        ({"emp_id": -key}, key == 12),  # others report to 12
    ]
    refused = sum(_refused(lambda: change(*x)) for x in unsound)
    # together the key and what refers to it may change
    moved = {"emp_id": F.when(key == 12, -key).otherwise(key), "manager_id": F.when(boss == 12, -boss).otherwise(boss)}
    change(moved, (key == 12) | (boss == 12))
    change({"email": F.lit("moved@x.org")}, key == -12)
    change({"dept_id": F.lit(3)}, key == 21)
    return stored.read().select(F.lit(refused).alias("refused"), "*")


@query(
    "dml_12_update_view_under_rules",
    """SELECT 2 AS refused, * REPLACE (CASE WHEN dept_id = 1 AND emp_id < 500 THEN CAST(0 AS DECIMAL(10,2)) ELSE salary END AS salary) FROM emp""",
    "emp",
)
def update_view_under_rules(t: Tables) -> DataFrame:
    """A view lets through what it shows, and the table's rules still hold."""
    stored = StoredTable.fresh(t.spark, "emp")
    stored.write(t.emp)
    view = TableView(stored, UNDER_RULES, ["emp_id", "salary", "dept_id"], F.col("dept_id") == 1)
    below_zero, same_key = {"salary": F.lit(-1)}, {"emp_id": F.lit(-9)}
    refused = sum(_refused(lambda: view.update(values, F.col("emp_id") < 500)) for values in (below_zero, same_key))
    view.update({"salary": F.lit(0)}, F.col("emp_id") < 500)
    return stored.read().select(F.lit(refused).alias("refused"), "*")


@query(
    "dml_14_delete_in_partitions",
    """SELECT 2 AS written, * FROM emp
       WHERE (segment IN ('BUILDING', 'MACHINERY') AND (hire_date < '2020-01-01' OR segment = 'MACHINERY')) IS NOT TRUE""",
    "emp",
)
def delete_in_partitions(t: Tables) -> DataFrame:
    """One partition loses some rows and is written again, one loses all and goes, the others' files stay."""
    stored = StoredTable.fresh(t.spark, "emp")
    stored.write(t.emp, partition_by=("segment",))
    early = F.col("hire_date") < day("2020-01-01")
    where = F.col("segment").isin("BUILDING", "MACHINERY") & (early | (F.col("segment") == "MACHINERY"))
    written = stored.delete_in_partitions(where, ("segment",))
    return stored.read().select(F.lit(written).alias("written"), *t.emp.columns)


@query(
    "dml_14_delete",
    "SELECT * FROM staff WHERE status IS DISTINCT FROM 'Terminated'",
    "staff",
)
def delete(t: Tables) -> DataFrame:
    return changes.delete(t.staff, F.col("status") == "Terminated")


@query("dml_14_delete_by_date", "SELECT * FROM proj WHERE NOT end_date < '2024-01-01'", "proj")
def delete_by_date(t: Tables) -> DataFrame:
    return changes.delete(t.proj, F.col("end_date") < day("2024-01-01"))


@query(
    "dml_15_delete_and",
    """SELECT * FROM staff WHERE (salary < 40000 AND hire_date > '2023-01-01' AND department IS NULL)
       IS NOT TRUE""",
    "staff",
)
def delete_and(t: Tables) -> DataFrame:
    late = (F.col("salary") < 40000) & (F.col("hire_date") > day("2023-01-01"))
    return changes.delete(t.staff, late & F.col("department").isNull())


@query(
    "dml_16_delete_any_null",
    "SELECT * FROM staff WHERE salary IS NOT NULL AND department IS NOT NULL",
    "staff",
)
def delete_any_null(t: Tables) -> DataFrame:
    return t.staff.dropna(how="any", subset=["salary", "department"])


@query(
    "dml_17_delete_not_in_captured",
    """SELECT * FROM dept WHERE NOT (dept_id NOT IN (
         SELECT DISTINCT dept_id FROM staff WHERE department IS NOT NULL))""",
    "staff dept",
)
def delete_not_in_captured(t: Tables) -> DataFrame:
    # the inner column does not exist in staff, so it is the department's own key: the set
    # is that key as long as any employee has a department, and empty otherwise
    return t.dept.filter(t.staff.filter(F.col("department").isNotNull()).exists())


@query(
    "dml_17_delete_not_in",
    """SELECT * FROM unit WHERE dept_name IN (SELECT department FROM staff WHERE department IS NOT NULL)""",
    "staff unit",
)
def delete_not_in(t: Tables) -> DataFrame:
    used = t.staff.select("department").dropna()
    return changes.delete_not_in(t.unit, "dept_name", used, "department")


@query(
    "dml_17_delete_not_in_with_null",
    """SELECT * FROM emp WHERE (manager_id NOT IN (SELECT emp_id FROM asg)) IS NOT TRUE""",
    "emp asg",
)
def delete_not_in_with_null(t: Tables) -> DataFrame:
    workers = t.asg.select(F.col("emp_id").alias("worker"))
    return changes.delete_not_in(t.emp, "manager_id", workers, "worker")


@query(
    "dml_18_move",
    """SELECT CASE WHEN end_date < '2024-01-01' THEN 'moved' ELSE 'kept' END AS part, * FROM proj""",
    "proj",
)
def move(t: Tables) -> DataFrame:
    stored = StoredTable.fresh(t.spark, "proj")
    moved, kept = changes.move(t.proj, F.col("end_date") < day("2024-01-01"), stored)
    return moved.select(F.lit("moved").alias("part"), "*").union(kept.select(F.lit("kept").alias("part"), "*"))


@query(
    "dml_19_audit",
    """SELECT emp_id, salary AS old_salary, salary + 5000 AS new_salary FROM staff
       WHERE department = 'BUILDING'""",
    "staff",
)
def audit(t: Tables) -> DataFrame:
    """The audit rows are written before the update and must agree with its result."""
    table_ = StoredTable.fresh(t.spark, "staff")
    before = table_.write(t.staff)
    where = F.col("department") == "BUILDING"
    after = table_.write(changes.update(table_.read(), {"salary": F.col("salary") + 5000}, where))
    old = table_.read(before).filter(where).select("emp_id", F.col("salary").alias("old_salary"))
    new = table_.read(after).filter(where).select("emp_id", F.col("salary").alias("new_salary"))
    return old.join(new, "emp_id")


@query(
    "dml_20_cascade",
    """SELECT * FROM lineitem WHERE l_orderkey NOT IN
         (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def cascade(t: Tables) -> DataFrame:
    gone = t.scan("orders").filter(F.col("o_orderstatus") == "F")
    kept, _ = changes.cascade(t.scan("lineitem"), "l_orderkey", gone, "o_orderkey")
    return kept


@query(
    "dml_20_cascade_lost",
    """SELECT * FROM lineitem WHERE l_orderkey IN
         (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000)""",
)
def cascade_lost(t: Tables) -> DataFrame:
    """The lines that go with few orders: on large tables a bloom filter of these keeps the other lines from the shuffle."""
    gone = t.scan("orders").filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000))
    return lines_lost(t.scan("lineitem"), gone)


def lines_lost(lines: DataFrame, gone: DataFrame) -> DataFrame:
    return joins.matched(lines, gone, {"l_orderkey": "o_orderkey"}, unique=True)


@query(
    "dml_20_cascade_chain",
    """SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders
         WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'))""",
)
def cascade_chain(t: Tables) -> DataFrame:
    customer = table("customer", "c_custkey bigint", primary_key=("c_custkey",))
    orders = table(
        "orders", "o_orderkey bigint, o_custkey bigint", primary_key=("o_orderkey",),
        foreign_keys=(references("o_custkey", customer, "cascade"),),
    )
    lineitem = table(
        "lineitem", "l_orderkey bigint", foreign_keys=(references("l_orderkey", orders, "cascade"),)
    )
    tables = {s.name: (t.scan(s.name), s) for s in (customer, orders, lineitem)}
    return changes.delete_parents(tables, "customer", F.col("c_mktsegment") == "MACHINERY")["lineitem"]


@query(
    "dml_20_cascade_hierarchy",
    """SELECT * FROM emp WHERE emp_id NOT IN (
         WITH RECURSIVE gone AS (SELECT emp_id FROM emp WHERE dept_id = 1 AND emp_id < 100
           UNION SELECT e.emp_id FROM emp e JOIN gone g ON e.manager_id = g.emp_id)
         SELECT emp_id FROM gone)""",
    "emp",
)
def cascade_hierarchy(t: Tables) -> DataFrame:
    """Whoever reports to a deleted employee, at any distance, goes as well."""
    spec = replace(EMP, foreign_keys=(ForeignKey(("manager_id",), "emp", ("emp_id",), "cascade"),))
    where = (F.col("dept_id") == 1) & (F.col("emp_id") < 100)
    return changes.delete_parents({"emp": (t.emp, spec)}, "emp", where)["emp"]


BUCKETS = 16


def _bucketed(t: Tables, name: str, key: str) -> DataFrame:
    """A table stored in buckets of its key, so that joins on the key move no row."""
    stored = StoredTable.fresh(t.spark, name)
    stored.write(t.scan(name), bucket_by=(BUCKETS, key))
    return stored.read()


@query(
    "dml_20_cascade_bucketed",
    """SELECT * FROM lineitem WHERE l_orderkey NOT IN
         (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def cascade_bucketed(t: Tables) -> DataFrame:
    """Orders and lines lie in buckets of the order key: the delete moves neither."""
    return cascade_in_buckets(_bucketed(t, "orders", "o_orderkey"), _bucketed(t, "lineitem", "l_orderkey"))


def cascade_in_buckets(orders: DataFrame, lines: DataFrame) -> DataFrame:
    gone = orders.filter(F.col("o_orderstatus") == "F")
    return joins.unmatched(lines, gone, {"l_orderkey": "o_orderkey"}, unique=True)


_RESTRICT_SQL = """SELECT * FROM dept WHERE ({0}) IS NOT TRUE
       OR EXISTS (SELECT 1 FROM emp JOIN dept x USING (dept_id) WHERE {0})"""


@query("dml_21_restrict_refused", _RESTRICT_SQL.format("location = 'ASIA'"), "emp dept")
def restrict_refused(t: Tables) -> DataFrame:
    return changes.delete_restricted(t.dept, F.col("location") == "ASIA", "dept_id", t.emp, "dept_id")


@query("dml_21_restrict_allowed", _RESTRICT_SQL.format("dept_id >= 20"), "emp dept")
def restrict_allowed(t: Tables) -> DataFrame:
    return changes.delete_restricted(t.dept, F.col("dept_id") >= 20, "dept_id", t.emp, "dept_id")


@query(
    "dml_21_blockers",
    "SELECT p_partkey, p_name FROM part WHERE p_size < 5 AND p_partkey IN (SELECT l_partkey FROM lineitem)",
)
def blockers(t: Tables) -> DataFrame:
    doomed = t.scan("part").filter(F.col("p_size") < 5).select("p_partkey", "p_name")
    return changes.blockers(doomed, "p_partkey", t.scan("lineitem"), "l_partkey")


@query(
    "dml_22_set_null",
    """SELECT * REPLACE (CASE WHEN o_custkey IN (SELECT c_custkey FROM customer
         WHERE c_mktsegment = 'MACHINERY') THEN NULL ELSE o_custkey END AS o_custkey) FROM orders""",
)
def set_null(t: Tables) -> DataFrame:
    gone = t.scan("customer").filter(F.col("c_mktsegment") == "MACHINERY")
    return changes.set_null(t.scan("orders"), "o_custkey", gone, "c_custkey")
