"""Grouped and global aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import average, money, ratio, total
from tablewright.operators.aggregates import fan_out_totals, per_key, with_children
from tablewright.sources.tables import Tables
from tablewright.workloads.registry import query, sql_avg, sql_ratio


@query(
    "agg_01_average",
    f"SELECT segment, {sql_avg('salary')} AS average_salary FROM emp GROUP BY segment",
    "emp",
)
def average_by_group(t: Tables) -> DataFrame:
    return t.emp.groupBy("segment").agg(average("salary").alias("average_salary"))


@query(
    "agg_01_average_null_group",
    f"SELECT dept_id, {sql_avg('salary')} AS average_salary FROM emp GROUP BY dept_id",
    "emp",
)
def average_null_group(t: Tables) -> DataFrame:
    return t.emp.groupBy("dept_id").agg(average("salary").alias("average_salary"))


@query(
    "agg_02_join_sum",
    """SELECT p.project_name, CAST(SUM(a.hours_worked) AS DECIMAL(38,2)) AS total_hours_worked
       FROM proj p JOIN asg a ON p.project_id = a.project_id GROUP BY p.project_id, p.project_name""",
    "proj asg",
)
def join_sum(t: Tables) -> DataFrame:
    hours = per_key(t.asg, "project_id", total_hours_worked=total("hours_worked"))
    return t.proj.join(hours, "project_id").select("project_name", "total_hours_worked")


@query(
    "agg_03_having_count",
    """SELECT department, CAST(COUNT(*) AS BIGINT) AS employee_count FROM staff
       GROUP BY department HAVING COUNT(*) > 100""",
    "staff",
)
def having_count(t: Tables) -> DataFrame:
    counts = t.staff.groupBy("department").agg(F.count("*").alias("employee_count"))
    return counts.filter(F.col("employee_count") > 100)


@query(
    "agg_04_global",
    """SELECT MAX(salary) AS max_salary, MIN(salary) AS min_salary,
         CAST(SUM(salary) AS DECIMAL(38,2)) AS total_payroll FROM emp""",
    "emp",
)
def global_(t: Tables) -> DataFrame:
    return t.emp.agg(
        F.max("salary").alias("max_salary"),
        F.min("salary").alias("min_salary"),
        total("salary").alias("total_payroll"),
    )


@query(
    "agg_04_global_empty",
    """SELECT MAX(salary) AS max_salary, CAST(SUM(salary) AS DECIMAL(38,2)) AS total_payroll,
         CAST(COUNT(*) AS BIGINT) AS n FROM emp WHERE salary < 0""",
    "emp",
)
def global_empty(t: Tables) -> DataFrame:
    return t.emp.filter(F.col("salary") < 0).agg(
        F.max("salary").alias("max_salary"), total("salary").alias("total_payroll"), F.count("*").alias("n")
    )


@query(
    "agg_05_count_distinct",
    """SELECT p.project_name, CAST(SUM(a.hours_worked) AS DECIMAL(38,2)) AS total_hours,
         CAST(COUNT(DISTINCT a.emp_id) AS BIGINT) AS employee_count
       FROM proj p JOIN asg a ON p.project_id = a.project_id
       GROUP BY p.project_id, p.project_name HAVING SUM(a.hours_worked) > 8000""",
    "proj asg",
)
def count_distinct(t: Tables) -> DataFrame:
    # one row per project and employee first: a hot project is spread over its employees
    pairs = t.asg.groupBy("project_id", "emp_id").agg(total("hours_worked").alias("hours"))
    work = per_key(
        pairs, "project_id",
        total_hours=total("hours"), employee_count=F.count("emp_id"),
    )
    busy = work.filter(F.col("total_hours") > 8000)
    return t.proj.join(busy, "project_id").select("project_name", "total_hours", "employee_count")


@query(
    "agg_06_having_average",
    f"""SELECT d.dept_name, {sql_avg('e.salary')} AS avg_salary
       FROM dept d JOIN emp e ON d.dept_id = e.dept_id
       GROUP BY d.dept_id, d.dept_name HAVING SUM(e.salary) > 44000 * COUNT(e.salary)""",
    "emp dept",
)
def having_average(t: Tables) -> DataFrame:
    # the mean itself is compared, not the rounded one
    pay = per_key(t.emp, "dept_id", paid=F.sum("salary"), n=F.count("salary"), avg_salary=average("salary"))
    rich = pay.filter(F.col("paid") > 44000 * F.col("n"))
    return t.dept.join(rich, "dept_id").select("dept_name", "avg_salary")


DEPT_STATISTICS_SQL = f"""SELECT dept_id, dept_name, COALESCE(n, 0) AS employee_count,
         COALESCE(mean, 0) AS avg_salary, CAST(COALESCE(high, 0) AS DECIMAL(18,2)) AS max_salary,
         CAST(COALESCE(low, 0) AS DECIMAL(18,2)) AS min_salary
       FROM dept LEFT JOIN (SELECT dept_id, COUNT(*) AS n, {sql_avg('salary')} AS mean,
                              MAX(salary) AS high, MIN(salary) AS low FROM emp GROUP BY dept_id)
         USING (dept_id)"""


def dept_statistics(dept: DataFrame, emp: DataFrame) -> DataFrame:
    return with_children(
        dept.select("dept_id", "dept_name"),
        emp,
        "dept_id",
        {"employee_count": 0, "avg_salary": 0, "max_salary": 0, "min_salary": 0},
        employee_count=F.count("*"),
        avg_salary=average("salary"),
        max_salary=money(F.max("salary")),
        min_salary=money(F.min("salary")),
    )


@query("agg_07_dept_statistics", DEPT_STATISTICS_SQL, "emp dept")
def dept_statistics_query(t: Tables) -> DataFrame:
    return dept_statistics(t.dept, t.emp)


PROJECT_OVERVIEW_SQL = """SELECT project_name, budget, dept_name, location,
         (SELECT COUNT(*) FROM emp e WHERE e.dept_id = p.dept_id) AS team_size
       FROM proj p JOIN dept USING (dept_id)"""


def project_overview(proj: DataFrame, dept: DataFrame, emp: DataFrame) -> DataFrame:
    teams = with_children(dept, emp, "dept_id", {"team_size": 0}, team_size=F.count("*"))
    return proj.join(teams, "dept_id").select("project_name", "budget", "dept_name", "location", "team_size")


@query("agg_08_team_size", PROJECT_OVERVIEW_SQL, "emp dept proj")
def team_size(t: Tables) -> DataFrame:
    return project_overview(t.proj, t.dept, t.emp)


@query(
    "agg_09_over_view",
    f"""SELECT CAST(COUNT(*) AS BIGINT) AS total_projects, CAST(SUM(budget) AS DECIMAL(38,2)) AS total_budgets
       FROM ({PROJECT_OVERVIEW_SQL})""",
    "emp dept proj",
)
def over_view(t: Tables) -> DataFrame:
    overview = project_overview(t.proj, t.dept, t.emp)
    return overview.agg(F.count("*").alias("total_projects"), total("budget").alias("total_budgets"))


# Every row of a department's employees beside every row of its projects, as an outer join
# of both children builds them.
_REPEATED = """(SELECT dept.*, emp_id, salary, project_id, budget
         FROM dept LEFT JOIN emp USING (dept_id) LEFT JOIN proj USING (dept_id))"""

DEPT_SUMMARY_SQL = f"""SELECT dept_id, dept_name, CAST(COUNT(emp_id) AS DECIMAL(38,0)) AS total_employees,
         CAST(COALESCE(SUM(salary), 0) AS DECIMAL(38,2)) AS total_salaries,
         CAST(COUNT(project_id) AS DECIMAL(38,0)) AS total_projects,
         CAST(COALESCE(SUM(budget), 0) AS DECIMAL(38,2)) AS total_budget
       FROM {_REPEATED} GROUP BY ALL"""


def dept_summary(dept: DataFrame, emp: DataFrame, proj: DataFrame) -> DataFrame:
    """Totals over the employee x project repetition inside each department."""
    totals = fan_out_totals(dept.select("dept_id", "dept_name"), "dept_id", emp, "salary", proj, "budget")
    return totals.select(
        "dept_id",
        "dept_name",
        F.col("first_count").alias("total_employees"),
        F.col("first_sum").alias("total_salaries"),
        F.col("second_count").alias("total_projects"),
        F.col("second_sum").alias("total_budget"),
    )


@query("agg_10_fan_out", DEPT_SUMMARY_SQL, "emp dept proj")
def fan_out(t: Tables) -> DataFrame:
    return dept_summary(t.dept, t.emp, t.proj)


@query(
    "agg_10_without_fan_out",
    """SELECT d.dept_id, d.dept_name,
         (SELECT CAST(COUNT(*) AS BIGINT) FROM emp e WHERE e.dept_id = d.dept_id) AS total_employees,
         COALESCE((SELECT CAST(SUM(salary) AS DECIMAL(38,2)) FROM emp e WHERE e.dept_id = d.dept_id), 0) AS total_salaries,
         (SELECT CAST(COUNT(*) AS BIGINT) FROM proj p WHERE p.dept_id = d.dept_id) AS total_projects,
         COALESCE((SELECT CAST(SUM(budget) AS DECIMAL(38,2)) FROM proj p WHERE p.dept_id = d.dept_id), 0) AS total_budget
       FROM dept d""",
    "emp dept proj",
)
def without_fan_out(t: Tables) -> DataFrame:
    totals = fan_out_totals(t.dept, "dept_id", t.emp, "salary", t.proj, "budget")
    return totals.select(
        "dept_id",
        "dept_name",
        F.col("first_count_distinct").alias("total_employees"),
        F.col("first_sum_distinct").alias("total_salaries"),
        F.col("second_count_distinct").alias("total_projects"),
        F.col("second_sum_distinct").alias("total_budget"),
    )


DASHBOARD_SQL = f"""SELECT dept_name, location, CAST(COUNT(emp_id) AS DECIMAL(38,0)) AS employee_count,
         COALESCE({sql_avg('salary')}, 0) AS avg_salary,
         CAST(COUNT(project_id) AS DECIMAL(38,0)) AS active_projects,
         CAST(COALESCE(SUM(budget), 0) AS DECIMAL(38,2)) AS total_budget,
         CASE WHEN COUNT(emp_id) > 0 THEN {sql_ratio('COALESCE(SUM(budget), 0)', 'COUNT(emp_id)')}
              ELSE 0 END AS budget_per_employee
       FROM {_REPEATED} GROUP BY dept_id, dept_name, location"""


def dashboard(dept: DataFrame, emp: DataFrame, proj: DataFrame) -> DataFrame:
    totals = fan_out_totals(dept, "dept_id", emp, "salary", proj, "budget")
    count, budget = F.col("first_count"), F.col("second_sum")
    # both totals are repeated alike, so their quotient is the plain budget over the
    # number of projects each employee row was repeated for
    repeats = F.greatest("second_count_distinct", F.lit(1))
    return totals.select(
        "dept_name",
        "location",
        count.alias("employee_count"),
        F.coalesce("first_average", F.lit(0)).cast("decimal(18,2)").alias("avg_salary"),
        F.col("second_count").alias("active_projects"),
        budget.alias("total_budget"),
        F.when(count > 0, ratio("second_sum_distinct", repeats))
        .otherwise(F.lit(0).cast("decimal(38,2)"))
        .alias("budget_per_employee"),
    )


@query("agg_11_guarded_ratio", DASHBOARD_SQL, "emp dept proj")
def guarded_ratio(t: Tables) -> DataFrame:
    return dashboard(t.dept, t.emp, t.proj)


@query(
    "agg_12_clamped",
    """SELECT dept_id, CAST(GREATEST(MAX(salary), 0) AS DECIMAL(18,2)) AS department_max_salary,
         CAST(LEAST(MIN(salary), 1000000) AS DECIMAL(18,2)) AS department_min_salary
       FROM emp GROUP BY dept_id""",
    "emp",
)
def clamped(t: Tables) -> DataFrame:
    return t.emp.groupBy("dept_id").agg(
        money(F.greatest(F.max("salary"), F.lit(0))).alias("department_max_salary"),
        money(F.least(F.min("salary"), F.lit(1000000))).alias("department_min_salary"),
    )


@query(
    "agg_13_derived_table",
    """SELECT x.dept_id, x.project_count, x.budget FROM (
         SELECT dept_id, CAST(COUNT(*) AS BIGINT) AS project_count,
                CAST(SUM(budget) AS DECIMAL(38,2)) AS budget FROM proj GROUP BY dept_id) x
       WHERE x.project_count > 1 AND x.budget > 200000""",
    "proj",
)
def derived_table(t: Tables) -> DataFrame:
    grouped = t.proj.groupBy("dept_id").agg(F.count("*").alias("project_count"), total("budget").alias("budget"))
    return grouped.filter((F.col("project_count") > 1) & (F.col("budget") > 200000))
