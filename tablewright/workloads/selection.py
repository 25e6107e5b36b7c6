"""Projections, filters, sorts, set operations and subquery predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import ratio, three_bands, total
from tablewright.operators import joins, subqueries
from tablewright.operators.aggregates import per_key
from tablewright.sources.tables import Tables, day
from tablewright.workloads import fixed
from tablewright.workloads.registry import query

# --- projections ----------------------------------------------------------------------


@query(
    "prj_01_aliases",
    "SELECT e.emp_name || ' / ' || e.segment AS full_name, e.segment AS department, e.salary AS pay FROM emp e",
    "emp",
)
def aliases(t: Tables) -> DataFrame:
    return t.emp.select(
        F.concat("emp_name", F.lit(" / "), "segment").alias("full_name"),
        F.col("segment").alias("department"),
        F.col("salary").alias("pay"),
    )


@query("prj_02_star", "SELECT * FROM emp", "emp")
def star(t: Tables) -> DataFrame:
    return t.emp


# Rounded quotients are stated in whole cents, because DuckDB divides decimals as doubles.
@query(
    "prj_03_arithmetic",
    """SELECT emp_name, salary AS annual_salary,
         CAST(CAST((2 * CAST(salary * 100 AS HUGEINT) + 12) // 24 AS DECIMAL(20,0)) * 0.01
              AS DECIMAL(38,2)) AS monthly_salary,
         CAST(salary * 0.1 AS DECIMAL(12,3)) AS raise_amount
       FROM emp""",
    "emp",
)
def arithmetic(t: Tables) -> DataFrame:
    return t.emp.select(
        "emp_name",
        F.col("salary").alias("annual_salary"),
        ratio("salary", F.lit(12)).alias("monthly_salary"),
        (F.col("salary") * F.expr("0.1")).cast("decimal(12,3)").alias("raise_amount"),
    )


@query("prj_04_distinct", "SELECT DISTINCT department FROM staff", "staff")
def distinct(t: Tables) -> DataFrame:
    return t.staff.select("department").distinct()


@query(
    "prj_05_case",
    """SELECT project_name, budget,
         CASE WHEN budget > 150000 THEN 'Large' WHEN budget BETWEEN 10000 AND 150000 THEN 'Medium'
              ELSE 'Small' END AS budget_category
       FROM proj""",
    "proj",
)
def case(t: Tables) -> DataFrame:
    category = three_bands("budget", fixed.BUDGET_BANDS)
    return t.proj.select("project_name", "budget", category.alias("budget_category"))


@query(
    "prj_06_section_label",
    """SELECT 'employees:' AS test, CAST(COUNT(*) AS BIGINT) AS row_count FROM emp
       UNION ALL SELECT 'departments:', COUNT(*) FROM dept
       UNION ALL SELECT 'projects:', COUNT(*) FROM proj""",
    "emp dept proj",
)
def section_label(t: Tables) -> DataFrame:
    parts = [
        df.agg(F.lit(label).alias("test"), F.count("*").alias("row_count"))
        for label, df in [("employees:", t.emp), ("departments:", t.dept), ("projects:", t.proj)]
    ]
    return parts[0].union(parts[1]).union(parts[2])


# --- filters --------------------------------------------------------------------------


@query("flt_01_date_literal", "SELECT * FROM emp WHERE hire_date > '2020-01-01'", "emp")
def date_literal(t: Tables) -> DataFrame:
    return t.emp.filter(F.col("hire_date") > day("2020-01-01"))


@query("flt_02_between", "SELECT * FROM emp WHERE salary BETWEEN 6000 AND 70000", "emp")
def between(t: Tables) -> DataFrame:
    return t.emp.filter(F.col("salary").between(6000, 70000))


@query(
    "flt_03_like",
    "SELECT * FROM emp WHERE segment LIKE 'B%' OR segment LIKE 'M%'",
    "emp",
)
def like(t: Tables) -> DataFrame:
    return t.emp.filter(F.col("segment").like("B%") | F.col("segment").like("M%"))


@query(
    "flt_04_not_like",
    "SELECT * FROM emp WHERE email NOT LIKE 'ma_hinery%' AND email NOT LIKE 'building'",
    "emp",
)
def not_like(t: Tables) -> DataFrame:
    return t.emp.filter(~F.col("email").like("ma_hinery%") & ~F.col("email").like("building"))


@query(
    "flt_05_null_tests",
    "SELECT * FROM emp WHERE manager_id IS NOT NULL AND segment = 'BUILDING'",
    "emp",
)
def null_tests(t: Tables) -> DataFrame:
    return t.emp.filter(F.col("manager_id").isNotNull() & (F.col("segment") == "BUILDING"))


@query("flt_05_is_null", "SELECT * FROM emp WHERE dept_id IS NULL OR email IS NULL", "emp")
def is_null(t: Tables) -> DataFrame:
    return t.emp.filter(F.col("dept_id").isNull() | F.col("email").isNull())


@query(
    "flt_06_in_list",
    "SELECT * FROM emp WHERE segment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD')",
    "emp",
)
def in_list(t: Tables) -> DataFrame:
    return t.emp.filter(F.col("segment").isin("BUILDING", "FURNITURE", "HOUSEHOLD"))


@query(
    "flt_07_logic",
    "SELECT * FROM emp WHERE salary > 60000 AND hire_date < '2020-01-01' OR NOT (dept_id < 10)",
    "emp",
)
def logic(t: Tables) -> DataFrame:
    early = (F.col("salary") > 60000) & (F.col("hire_date") < day("2020-01-01"))
    return t.emp.filter(early | ~(F.col("dept_id") < 10))


@query("flt_08_never", "SELECT * FROM emp WHERE 1 = 0", "emp")
def never(t: Tables) -> DataFrame:
    return t.emp.filter(F.lit(False))


# --- sorts and top-k ------------------------------------------------------------------


@query(
    "sort_01_alias_desc",
    """SELECT segment, CAST(COUNT(*) AS BIGINT) AS employee_count FROM emp
       GROUP BY segment ORDER BY employee_count DESC NULLS FIRST, segment""",
    "emp",
)
def alias_desc(t: Tables) -> DataFrame:
    counts = t.emp.groupBy("segment").agg(F.count("*").alias("employee_count"))
    return counts.orderBy(F.desc_nulls_first("employee_count"), "segment")


@query(
    "sort_02_mixed",
    """SELECT segment, salary, emp_id FROM emp
       ORDER BY segment ASC NULLS LAST, salary DESC NULLS FIRST, emp_id""",
    "emp",
)
def mixed(t: Tables) -> DataFrame:
    # the unique last key lets the range partitioning cut through equal leading keys
    return t.emp.select("segment", "salary", "emp_id").orderBy(
        F.asc_nulls_last("segment"), F.desc_nulls_first("salary"), "emp_id"
    )


@query(
    "sort_03_top_k",
    "SELECT emp_name, salary FROM emp ORDER BY salary DESC NULLS LAST, emp_id LIMIT 1",
    "emp",
)
def top_k(t: Tables) -> DataFrame:
    return t.emp.orderBy(F.desc_nulls_last("salary"), "emp_id").limit(1).select("emp_name", "salary")


# --- set operations -------------------------------------------------------------------


@query(
    "set_01_union",
    """SELECT emp_id, emp_name, salary FROM emp WHERE salary > 65000
       UNION SELECT emp_id, emp_name, salary FROM emp WHERE hire_date > '2020-01-01'""",
    "emp",
)
def union(t: Tables) -> DataFrame:
    cols = ["emp_id", "emp_name", "salary"]
    rich = t.emp.filter(F.col("salary") > 65000).select(cols)
    recent = t.emp.filter(F.col("hire_date") > day("2020-01-01")).select(cols)
    return rich.union(recent).distinct()


@query(
    "set_01_union_nulls",
    "SELECT dept_id, manager_id FROM emp UNION SELECT dept_id, NULL FROM proj",
    "emp proj",
)
def union_nulls(t: Tables) -> DataFrame:
    other = t.proj.select("dept_id", F.lit(None).cast("bigint").alias("manager_id"))
    return t.emp.select("dept_id", "manager_id").union(other).distinct()


@query(
    "set_02_intersect",
    """SELECT emp_id, emp_name FROM emp WHERE segment = 'BUILDING'
       INTERSECT SELECT emp_id, emp_name FROM emp WHERE salary > 65000""",
    "emp",
)
def intersect(t: Tables) -> DataFrame:
    cols = ["emp_id", "emp_name"]
    builders = t.emp.filter(F.col("segment") == "BUILDING").select(cols)
    return builders.intersect(t.emp.filter(F.col("salary") > 65000).select(cols))


@query(
    "set_03_except",
    """SELECT emp_id, emp_name FROM emp
       EXCEPT SELECT e.emp_id, e.emp_name FROM emp e JOIN asg a ON e.emp_id = a.emp_id""",
    "emp asg",
)
def except_(t: Tables) -> DataFrame:
    e = t.emp.select("emp_id", "emp_name")
    # as a set, the joined side is the employees that have an assignment
    return e.subtract(joins.matched(e, t.asg, "emp_id"))


# --- subquery predicates --------------------------------------------------------------


@query(
    "sub_01_exists",
    "SELECT * FROM emp e WHERE EXISTS (SELECT 1 FROM asg a WHERE a.emp_id = e.emp_id)",
    "emp asg",
)
def exists(t: Tables) -> DataFrame:
    return joins.matched(t.emp, t.asg, "emp_id")


@query(
    "sub_02_not_exists",
    """SELECT emp_id, 'nobody earns 200000' AS note FROM emp
         WHERE NOT EXISTS (SELECT 1 FROM emp WHERE salary > 200000)
       UNION ALL SELECT emp_id, 'nobody earns 60000' FROM emp
         WHERE NOT EXISTS (SELECT 1 FROM emp WHERE salary > 60000)""",
    "emp",
)
def not_exists(t: Tables) -> DataFrame:
    def unless(limit: int) -> DataFrame:
        above = t.emp.filter(F.col("salary") > limit)
        return t.emp.filter(~above.exists()).select("emp_id", F.lit(f"nobody earns {limit}").alias("note"))

    return unless(200000).union(unless(60000))


@query(
    "sub_03_in_join",
    """SELECT * FROM emp WHERE emp_id IN (SELECT DISTINCT a.emp_id FROM asg a
         JOIN proj p ON a.project_id = p.project_id WHERE p.status = 'Active')""",
    "emp asg proj",
)
def in_join(t: Tables) -> DataFrame:
    active = t.proj.filter(F.col("status") == "Active").select("project_id")
    return joins.matched(t.emp, t.asg.join(active, "project_id"), "emp_id")


_NOT_IN_SQL = """SELECT 'clean set' AS case_name, emp_id FROM emp
         WHERE manager_id NOT IN (SELECT emp_id FROM emp WHERE salary > 50000)
       UNION ALL SELECT 'set with NULL', emp_id FROM emp
         WHERE manager_id NOT IN (SELECT emp_id FROM asg)
       UNION ALL SELECT 'empty set', emp_id FROM emp
         WHERE manager_id NOT IN (SELECT emp_id FROM emp WHERE salary < 0)"""


@query("sub_04_not_in", _NOT_IN_SQL, "emp asg")
def not_in(t: Tables) -> DataFrame:
    def keep(label: str, others: DataFrame) -> DataFrame:
        kept = subqueries.not_in(t.emp.select("emp_id", "manager_id"), "manager_id", others, "boss")
        return kept.select(F.lit(label).alias("case_name"), "emp_id")

    bosses = t.emp.select(F.col("emp_id").alias("boss"), "salary")
    return (
        keep("clean set", bosses.filter("salary > 50000"))
        .union(keep("set with NULL", t.asg.select(F.col("emp_id").alias("boss"))))
        .union(keep("empty set", bosses.filter("salary < 0")))
    )


@query(
    "sub_05_above_any",
    "SELECT * FROM emp WHERE salary > ANY (SELECT salary FROM emp WHERE segment = 'FURNITURE')",
    "emp",
)
def above_any(t: Tables) -> DataFrame:
    others = t.emp.filter(F.col("segment") == "FURNITURE").select("salary")
    return subqueries.above_any(t.emp, "salary", others, "salary")


@query(
    "sub_06_scalar_aggregate",
    """SELECT e.emp_id, (SELECT CAST(COUNT(*) AS BIGINT) FROM asg a WHERE a.emp_id = e.emp_id) AS jobs,
         (SELECT CAST(SUM(a.hours_worked) AS DECIMAL(38,2)) FROM asg a WHERE a.emp_id = e.emp_id) AS hours
       FROM emp e""",
    "emp asg",
)
def scalar_aggregate(t: Tables) -> DataFrame:
    work = per_key(t.asg, "emp_id", jobs=F.count("*"), hours=total("hours_worked"))
    joined = t.emp.select("emp_id").join(work, "emp_id", "left")
    return joined.select("emp_id", F.coalesce("jobs", F.lit(0)).alias("jobs"), "hours")


@query(
    "sub_07_scalar_lookup",
    """SELECT emp_id, CASE WHEN (SELECT budget FROM unit u WHERE u.dept_name = s.department) > 100000
         THEN 'rich' ELSE 'plain' END AS kind FROM staff s""",
    "staff unit",
)
def scalar_lookup(t: Tables) -> DataFrame:
    s = subqueries.single_value(t.staff, "department", t.unit, "dept_name", "budget", "budget")
    return s.select("emp_id", F.when(F.col("budget") > fixed.RICH_UNIT, "rich").otherwise("plain").alias("kind"))


@query(
    "sub_08_count_filter",
    "SELECT d.* FROM dept d WHERE (SELECT COUNT(*) FROM proj p WHERE p.dept_id = d.dept_id) > 3",
    "dept proj",
)
def count_filter(t: Tables) -> DataFrame:
    counts = per_key(t.proj, "dept_id", n=F.count("*"))
    joined = t.dept.join(counts, "dept_id", "left")
    return joined.filter(F.coalesce("n", F.lit(0)) > 3).drop("n")
