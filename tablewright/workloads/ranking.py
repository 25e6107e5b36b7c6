"""Ranks and top rows per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import average, money
from tablewright.operators.aggregates import per_key
from tablewright.operators.ranking import top_key, with_rows
from tablewright.plans.order import rank_by
from tablewright.plans.prefix import rank_in_group
from tablewright.sources.tables import Tables
from tablewright.workloads.registry import query, sql_avg

# The rank of a correlated count, written as a window for speed; a NULL group or score
# counts nothing and ranks 1.
_RANK = """CASE WHEN {0} IS NULL OR salary IS NULL THEN 1
           ELSE CAST(RANK() OVER (PARTITION BY {0} ORDER BY salary DESC NULLS LAST) AS BIGINT) END"""


@query(
    "win_01_rank",
    f"SELECT emp_id, dept_id, salary, {_RANK.format('dept_id')} AS salary_rank FROM emp",
    "emp",
)
def rank(t: Tables) -> DataFrame:
    return rank_in_group(t.emp.select("emp_id", "dept_id", "salary"), "dept_id", "salary", "salary_rank")


@query(
    "win_01_rank_correlated",
    """SELECT e.emp_id, (SELECT CAST(COUNT(*) + 1 AS BIGINT) FROM emp e2
         WHERE e2.segment = e.segment AND e2.salary > e.salary) AS salary_rank FROM emp e""",
    "emp",
)
def rank_correlated(t: Tables) -> DataFrame:
    e = t.emp.select("emp_id", "segment", "salary")
    ranked = rank_in_group(e, "segment", "salary", "salary_rank")
    return ranked.select("emp_id", "salary_rank")


_RANK_BY = """CASE WHEN dept_id IS NULL OR {0} IS NULL THEN 1
           ELSE CAST(RANK() OVER (PARTITION BY dept_id ORDER BY {0} DESC NULLS LAST) AS BIGINT) END"""


@query(
    "win_01_rank_by_date",
    f"SELECT emp_id, dept_id, hire_date, {_RANK_BY.format('hire_date')} AS date_rank FROM emp",
    "emp",
)
def rank_by_date(t: Tables) -> DataFrame:
    return rank_by(t.emp.select("emp_id", "dept_id", "hire_date"), "dept_id", "hire_date", "date_rank")


@query(
    "win_01_rank_by_text",
    f"SELECT emp_id, dept_id, email, {_RANK_BY.format('email')} AS email_rank FROM emp",
    "emp",
)
def rank_by_text(t: Tables) -> DataFrame:
    return rank_by(t.emp.select("emp_id", "dept_id", "email"), "dept_id", "email", "email_rank")


@query(
    "win_02_rank_with_average",
    f"""WITH ranked AS (SELECT *, {_RANK.format('segment')} AS salary_rank FROM emp),
         hours AS (SELECT emp_id, {sql_avg('hours_worked')} AS avg_hours_worked FROM asg GROUP BY emp_id)
       SELECT emp_name AS employee_name, segment, salary, avg_hours_worked, salary_rank
       FROM ranked LEFT JOIN hours USING (emp_id)
       ORDER BY segment NULLS LAST, salary DESC NULLS FIRST, emp_id""",
    "emp asg",
)
def rank_with_average(t: Tables) -> DataFrame:
    # rank before the join: afterwards employees would count once per assignment
    e = t.emp.select("emp_id", "emp_name", "segment", "salary")
    ranked = rank_in_group(e, "segment", "salary", "salary_rank")
    hours = per_key(t.asg, "emp_id", avg_hours_worked=average("hours_worked"))
    return (
        ranked.join(hours, "emp_id", "left")
        .orderBy(F.asc_nulls_last("segment"), F.desc_nulls_first("salary"), "emp_id")
        .select(
            F.col("emp_name").alias("employee_name"), "segment", "salary", "avg_hours_worked", "salary_rank"
        )
    )


@query(
    "win_03_top_row",
    """SELECT d.dept_id, d.dept_name, (SELECT e.emp_name FROM emp e WHERE e.dept_id = d.dept_id
         ORDER BY e.salary DESC NULLS LAST, e.emp_id LIMIT 1) AS highest_paid_employee FROM dept d""",
    "emp dept",
)
def top_row(t: Tables) -> DataFrame:
    tops = per_key(t.emp, "dept_id", top=top_key(t.emp, "salary", "emp_id"))
    best = with_rows(tops, "top", t.emp, "emp_id", highest_paid_employee="emp_name")
    return t.dept.select("dept_id", "dept_name").join(best, "dept_id", "left")


@query(
    "win_04_group_summary",
    f"""SELECT x.dept_id, x.total_employees, x.average_salary,
         (SELECT e.emp_name FROM emp e WHERE e.dept_id = x.dept_id
          ORDER BY e.salary DESC NULLS LAST, e.emp_id LIMIT 1) AS highest_paid_employee,
         x.department_max_salary, x.department_min_salary
       FROM (SELECT dept_id, CAST(COUNT(*) AS BIGINT) AS total_employees,
               {sql_avg('salary')} AS average_salary,
               CAST(GREATEST(MAX(salary), 0) AS DECIMAL(18,2)) AS department_max_salary,
               CAST(LEAST(MIN(salary), 1000000) AS DECIMAL(18,2)) AS department_min_salary
             FROM emp GROUP BY dept_id) x""",
    "emp",
)
def group_summary(t: Tables) -> DataFrame:
    groups = t.emp.groupBy("dept_id").agg(
        F.count("*").alias("total_employees"),
        average("salary").alias("average_salary"),
        top_key(t.emp, "salary", "emp_id").alias("top"),
        money(F.greatest(F.max("salary"), F.lit(0))).alias("department_max_salary"),
        money(F.least(F.min("salary"), F.lit(1000000))).alias("department_min_salary"),
    )
    named = with_rows(groups, "top", t.emp, "emp_id", highest_paid_employee="emp_name")
    # a NULL group equals no row, so it has no highest paid employee
    known = F.when(F.col("dept_id").isNotNull(), F.col("highest_paid_employee"))
    return named.withColumn("highest_paid_employee", known)
