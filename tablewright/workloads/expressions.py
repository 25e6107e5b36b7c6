"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import concat_skip_null, format_text, ratio, whole_years
from tablewright.sources.tables import Tables, day
from tablewright.workloads import fixed
from tablewright.workloads.registry import query, sql_ratio


@query("fn_01_concat_operator", "SELECT emp_id, emp_name || ' ' || email AS label FROM emp", "emp")
def concat_operator(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", F.concat("emp_name", F.lit(" "), "email").alias("label"))


@query("fn_02_concat", "SELECT emp_id, CONCAT(emp_name, ' ', email) AS label FROM emp", "emp")
def concat(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", concat_skip_null("emp_name", F.lit(" "), "email").alias("label"))


@query("fn_03_upper", "SELECT emp_id, UPPER(emp_name || ' ' || email) AS label FROM emp", "emp")
def upper(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", F.upper(F.concat("emp_name", F.lit(" "), "email")).alias("label"))


@query("fn_04_length", "SELECT emp_id, CAST(LENGTH(email) AS BIGINT) AS n FROM emp", "emp")
def length(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", F.length("email").cast("bigint").alias("n"))


@query("fn_05_substring", "SELECT emp_id, SUBSTRING(email FROM 1 FOR 3) AS email_prefix FROM emp", "emp")
def substring(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", F.substring("email", 1, 3).alias("email_prefix"))


@query(
    "fn_06_format",
    """SELECT project_id, printf('Project: %s - Budget: $%s - Status: %s - Dept: %s', project_name,
         CAST(budget AS VARCHAR), status, COALESCE(CAST(dept_id AS VARCHAR), '')) AS project_info FROM proj""",
    "proj",
)
def format_(t: Tables) -> DataFrame:
    info = format_text(fixed.PROJECT_INFO + " - Dept: %s", "project_name", "budget", "status", "dept_id")
    return t.proj.select("project_id", info.alias("project_info"))


@query("fn_07_coalesce", "SELECT emp_id, COALESCE(email, 'No email provided') AS email FROM emp", "emp")
def coalesce(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", F.coalesce("email", F.lit(fixed.NO_EMAIL)).alias("email"))


@query(
    "fn_08_round",
    f"SELECT emp_id, {sql_ratio('salary', '7')} AS seventh, ROUND(salary, 1) AS tenths FROM emp",
    "emp",
)
def round_(t: Tables) -> DataFrame:
    return t.emp.select(
        "emp_id", ratio("salary", F.lit(7)).alias("seventh"), F.round("salary", 1).alias("tenths")
    )


@query(
    "fn_09_greatest_least",
    """SELECT emp_id, CAST(GREATEST(salary, 50000) AS DECIMAL(10,2)) AS at_least,
         CAST(LEAST(salary, 60000) AS DECIMAL(10,2)) AS at_most FROM emp""",
    "emp",
)
def greatest_least(t: Tables) -> DataFrame:
    low, high = (F.lit(v).cast("decimal(10,2)") for v in (50000, 60000))
    return t.emp.select(
        "emp_id", F.greatest("salary", low).alias("at_least"), F.least("salary", high).alias("at_most")
    )


@query("fn_10_year", "SELECT emp_id, EXTRACT(YEAR FROM hire_date) AS hired FROM emp", "emp")
def year(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", F.year("hire_date").cast("bigint").alias("hired"))


@query(
    "fn_11_whole_years",
    """SELECT emp_id, EXTRACT(YEAR FROM AGE(DATE '2020-02-29', hire_date)) AS years_with_company FROM emp""",
    "emp",
)
def years(t: Tables) -> DataFrame:
    return t.emp.select("emp_id", whole_years(day("2020-02-29"), "hire_date").alias("years_with_company"))


@query(
    "fn_12_current",
    """SELECT emp_id, emp_id % 7 - 3 <= 0 AS due, emp_id % 7 - 3 < 0 AS overdue, emp_id % 7 - 3 <= 0 AS due_by_now
       FROM emp""",
    "emp",
)
def current(t: Tables) -> DataFrame:
    """Days around today: a third of the dates is to come."""
    deadline = F.date_add(F.current_date(), (F.col("emp_id") % 7 - 3).cast("int"))
    return t.emp.select(
        "emp_id",
        (deadline <= F.current_date()).alias("due"),
        (deadline < F.current_date()).alias("overdue"),
        (F.now() >= deadline).alias("due_by_now"),
    )


@query("fn_13_date_shift", "SELECT project_id, end_date + 30 AS new_end FROM proj", "proj")
def date_shift(t: Tables) -> DataFrame:
    return t.proj.select("project_id", F.date_add("end_date", 30).alias("new_end"))


@query(
    "fn_14_decimal_arithmetic",
    f"""SELECT emp_id, CAST(salary * 1.10 AS DECIMAL(14,4)) AS raised,
         CAST(salary + 5000 AS DECIMAL(14,2)) AS bonus, {sql_ratio('salary', '12')} AS monthly FROM emp""",
    "emp",
)
def decimal_arithmetic(t: Tables) -> DataFrame:
    salary = F.col("salary")
    return t.emp.select(
        "emp_id",
        (salary * F.expr("1.10")).cast("decimal(14,4)").alias("raised"),
        (salary + 5000).cast("decimal(14,2)").alias("bonus"),
        ratio(salary, F.lit(12)).alias("monthly"),
    )


@query(
    "fn_15_text_to_date",
    """SELECT assignment_id, CAST(strftime(assignment_date, '%Y-%m-%d') AS DATE) AS d,
         assignment_date > '1998-01-15' AS late FROM asg""",
    "asg",
)
def text_to_date(t: Tables) -> DataFrame:
    return t.asg.select(
        "assignment_id",
        F.date_format("assignment_date", "yyyy-MM-dd").cast("date").alias("d"),
        (F.col("assignment_date") > F.lit("1998-01-15")).alias("late"),
    )
