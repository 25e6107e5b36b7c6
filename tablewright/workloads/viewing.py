"""Views and materialized views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import above
from tablewright.operators.quality import IntegrityError
from tablewright.plans.views import MaterializedView, create_view, drop_view, rename_view
from tablewright.sources.ingest import fill_missing, literal_rows
from tablewright.sources.spec import AddColumn, Field, alter, table
from tablewright.sources.stored import StoredTable
from tablewright.sources.tables import Tables
from tablewright.workloads.aggregation import (
    DASHBOARD_SQL,
    DEPT_STATISTICS_SQL,
    DEPT_SUMMARY_SQL,
    PROJECT_OVERVIEW_SQL,
    dashboard,
    dept_statistics,
    dept_summary,
    project_overview,
)
from tablewright.workloads import fixed
from tablewright.workloads.changes import EMP
from tablewright.workloads.registry import query


def _name(base: str) -> str:
    """A view name of its own, so that one session can run a query twice."""
    return f"{base}_{uuid.uuid4().hex[:12]}"


def _view(df: DataFrame, base: str) -> DataFrame:
    """``df`` read through a view, which is dropped again: its plan is known by then."""
    name = _name(base)
    view = create_view(df, name)
    drop_view(df.sparkSession, name)
    return view


def _details(t: Tables) -> DataFrame:
    return t.emp.join(t.dept, "dept_id").select("emp_id", "emp_name", "salary", "dept_name", "location")


_DETAILS_SQL = """SELECT e.emp_id, e.emp_name, e.salary, d.dept_name, d.location
       FROM emp e JOIN dept d ON e.dept_id = d.dept_id"""


@query("view_01_employee_details", _DETAILS_SQL, "emp dept")
def employee_details(t: Tables) -> DataFrame:
    return _view(_details(t), "employee_details")


@query("view_02_dept_statistics", DEPT_STATISTICS_SQL, "emp dept")
def dept_statistics_view(t: Tables) -> DataFrame:
    view = _view(dept_statistics(t.dept, t.emp), "dept_statistics")
    return view.orderBy(F.desc_nulls_first("employee_count"), "dept_id")


@query("view_03_project_overview", PROJECT_OVERVIEW_SQL, "emp dept proj")
def project_overview_view(t: Tables) -> DataFrame:
    view = _view(project_overview(t.proj, t.dept, t.emp), "project_overview")
    return view.orderBy(F.desc_nulls_first("team_size"), "project_name")


_HIGH_SQL = """SELECT e.emp_name, e.salary, d.dept_name FROM emp e LEFT JOIN dept d ON e.dept_id = d.dept_id
       WHERE e.salary > 55000"""


def _high(t: Tables) -> DataFrame:
    rich = t.emp.filter(F.col("salary") > fixed.HIGH_EARNER)
    return rich.join(t.dept, "dept_id", "left").select("emp_name", "salary", "dept_name")


@query("view_04_high_earners", _HIGH_SQL, "emp dept")
def high_earners(t: Tables) -> DataFrame:
    return _view(_high(t), "high_earners")


@query(
    "view_05_replace",
    f"""SELECT *, CASE WHEN salary > 60000 THEN 'High' WHEN salary > 50000 THEN 'Medium'
         ELSE 'Standard' END AS salary_grade FROM ({_DETAILS_SQL})""",
    "emp dept",
)
def replace(t: Tables) -> DataFrame:
    name = _name("employee_details")
    view = create_view(_details(t), name)
    grade = above("salary", fixed.SALARY_GRADES, fixed.SALARY_GRADE_ELSE)
    graded = create_view(view.withColumn("salary_grade", grade), name, replace=True)
    drop_view(t.spark, name)
    return graded


@query("view_06_rename", _HIGH_SQL, "emp dept")
def rename(t: Tables) -> DataFrame:
    old, new = _name("high_earners"), _name("top_performers")
    create_view(_high(t), old)
    renamed = rename_view(t.spark, old, new)
    drop_view(t.spark, new)
    return renamed


@query("view_07_create_drop", "SELECT * FROM emp WHERE salary < 50000", "emp")
def create_drop(t: Tables) -> DataFrame:
    name = _name("temp_view")
    rows = create_view(t.emp.filter(F.col("salary") < 50000), name)
    drop_view(t.spark, name)
    return rows


@query("view_08_projection", "SELECT emp_id, emp_name, dept_id, salary FROM emp", "emp")
def projection(t: Tables) -> DataFrame:
    return _view(t.emp.select("emp_id", "emp_name", "dept_id", "salary"), "employee_salaries")


@query("view_09_filtered", "SELECT emp_id, emp_name, dept_id, salary FROM emp WHERE dept_id = 1", "emp")
def filtered(t: Tables) -> DataFrame:
    chosen = t.emp.filter(F.col("dept_id") == 1).select("emp_id", "emp_name", "dept_id", "salary")
    return _view(chosen, "it_employees")


@query("view_10_row_restricted", "SELECT emp_id, emp_name, salary, dept_id FROM emp WHERE dept_id = 2", "emp")
def row_restricted(t: Tables) -> DataFrame:
    chosen = t.emp.filter(F.col("dept_id") == 2).select("emp_id", "emp_name", "salary", "dept_id")
    return _view(chosen, "hr_employee_view")


@query("view_11_column_restricted", "SELECT emp_id, emp_name, salary FROM emp", "emp")
def column_restricted(t: Tables) -> DataFrame:
    return _view(t.emp.select("emp_id", "emp_name", "salary"), "finance_employee_view")


@query("view_12_dashboard", DASHBOARD_SQL, "emp dept proj")
def dashboard_view(t: Tables) -> DataFrame:
    return _view(dashboard(t.dept, t.emp, t.proj), "dept_dashboard")


@query(
    "view_13_high_budget",
    f"""SELECT p.project_name, p.budget, d.dept_name, TIMESTAMP '2024-06-30 12:00:00' AS created_date,
         CASE {' '.join(f"WHEN p.budget > {least} THEN '{label}'" for label, least in fixed.APPROVALS.items())}
              ELSE '{fixed.APPROVAL_ELSE}' END AS approval_status
       FROM proj p JOIN dept d ON p.dept_id = d.dept_id WHERE p.budget > {fixed.HIGH_BUDGET}""",
    "dept proj",
)
def high_budget(t: Tables) -> DataFrame:
    status = above("budget", fixed.APPROVALS, fixed.APPROVAL_ELSE)
    created = AddColumn(Field("created_date", "timestamp", default="2024-06-30 12:00:00"))
    proj, _ = alter(t.proj, table("proj", "project_name text, budget numeric(12,2), dept_id int"), created)
    large = proj.filter(F.col("budget") > fixed.HIGH_BUDGET).join(t.dept, "dept_id")
    return _view(
        large.select("project_name", "budget", "dept_name", "created_date", status.alias("approval_status")),
        "high_budget_projects",
    )


# --- materialized views ---------------------------------------------------------------


@query("mv_01_with_data", DEPT_SUMMARY_SQL, "emp dept proj")
def with_data(t: Tables) -> DataFrame:
    mv = MaterializedView(StoredTable.fresh(t.spark, "dept_summary"), lambda: dept_summary(t.dept, t.emp, t.proj))
    mv.refresh()
    return mv.read()



@query(
    "mv_02_stale_then_refreshed",
    f"""WITH grown AS (SELECT emp_id, dept_id, salary FROM emp
         UNION ALL SELECT -8, 1, CAST(54000 AS DECIMAL(10,2)))
       SELECT 'before' AS state, * FROM ({DEPT_SUMMARY_SQL})
       UNION ALL SELECT 'after', * FROM ({DEPT_SUMMARY_SQL.replace("JOIN emp", "JOIN grown")})""",
    "emp dept proj",
)
def stale_then_refreshed(t: Tables) -> DataFrame:
    base = StoredTable.fresh(t.spark, "emp")
    base.write(t.emp)
    mv = MaterializedView(StoredTable.fresh(t.spark, "dept_summary"), lambda: dept_summary(t.dept, base.read(), t.proj))
    mv.refresh()
    columns = table("columns", "emp_id bigint, emp_name varchar(50), dept_id int, salary numeric(10,2)")
    base.append(fill_missing(literal_rows(t.spark, columns, [(-8, "Newcomer", 1, 54000)]), EMP))
    stale = mv.read()
    mv.refresh()
    before = stale.select(F.lit("before").alias("state"), "*")
    return before.union(mv.read().select(F.lit("after").alias("state"), "*"))


@query(
    "mv_03_keyed_refresh",
    f"""WITH grown AS (SELECT emp_id, dept_id, salary FROM emp
         UNION ALL SELECT -8, 1, CAST(54000 AS DECIMAL(10,2)))
       SELECT 'reader' AS state, FALSE AS refused, * FROM ({DEPT_SUMMARY_SQL})
       UNION ALL SELECT 'refreshed', TRUE, * FROM ({DEPT_SUMMARY_SQL.replace("JOIN emp", "JOIN grown")})""",
    "emp dept proj",
)
def keyed_refresh(t: Tables) -> DataFrame:
    """A reader keeps its rows while the table grows and the view is refreshed.

    A refresh that would repeat a key is refused and leaves the last result in place.
    """
    base = StoredTable.fresh(t.spark, "emp")
    base.write(t.emp)
    copies = [1]

    def plan() -> DataFrame:
        repeated = F.explode(F.array_repeat(F.lit(0), copies[0]))
        return dept_summary(t.dept, base.read(), t.proj).withColumn("copy", repeated).drop("copy")

    mv = MaterializedView(StoredTable.fresh(t.spark, "dept_summary"), plan, key=["dept_id"])
    mv.refresh()
    reader = mv.read()
    columns = table("columns", "emp_id bigint, emp_name varchar(50), dept_id int, salary numeric(10,2)")
    base.append(fill_missing(literal_rows(t.spark, columns, [(-8, "Newcomer", 1, 54000)]), EMP))
    mv.refresh()
    copies[0] = 2
    try:
        mv.refresh()
        refused = False
    except IntegrityError:
        refused = True
    before = reader.select(F.lit("reader").alias("state"), F.lit(False).alias("refused"), "*")
    return before.union(mv.read().select(F.lit("refreshed").alias("state"), F.lit(refused).alias("refused"), "*"))


@query(
    "mv_04_populated_later",
    """SELECT project_name, budget, dept_name,
         (SELECT COUNT(*) FROM emp e WHERE e.dept_id = p.dept_id) AS assigned_employees
       FROM proj p JOIN dept USING (dept_id)""",
    "emp dept proj",
)
def populated_later(t: Tables) -> DataFrame:
    def plan() -> DataFrame:
        overview = project_overview(t.proj, t.dept, t.emp).drop("location")
        return overview.withColumnRenamed("team_size", "assigned_employees")

    mv = MaterializedView(StoredTable.fresh(t.spark, "project_stats"), plan)
    try:
        mv.read()
    except LookupError:
        mv.refresh()
    return mv.read()
