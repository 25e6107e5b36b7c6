"""The stored tables and the working frames derived from them.

The stored tables hold no NULLs and no unmatched keys, so outer joins, anti joins and
integrity rules would have nothing to find. Each working frame is a projection of one
whole table in which some *values* become NULL by a fixed rule; no row is dropped.
``FRAME_SQL`` states the same frames as SQL common table expressions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that opening a table reads no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    "l_shipdate timestamp_ntz",
}


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def day(text: str):
    return F.lit(text).cast("date")


class Tables:
    """Stored tables and working frames of one data folder; everything is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def scan(self, name: str) -> DataFrame:
        return scan(self.spark, self.sf_dir, name)

    @cached_property
    def dept(self) -> DataFrame:
        nation, region = self.scan("nation"), self.scan("region")
        return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
            "n_nationkey AS dept_id", "n_name AS dept_name", "r_name AS location"
        )

    @cached_property
    def emp(self) -> DataFrame:
        return self.scan("customer").selectExpr(
            "c_custkey AS emp_id",
            "c_name AS emp_name",
            "c_mktsegment AS segment",
            "IF(c_nationkey >= 20 OR c_custkey % 50 = 7, NULL, c_nationkey) AS dept_id",
            "CAST(IF(c_custkey % 40 = 11, NULL, (CAST(c_acctbal AS DECIMAL(10,2)) + 1000) * 8)"
            " AS DECIMAL(10,2)) AS salary",
            "IF(c_custkey < 10, NULL, c_custkey div 10) AS manager_id",
            "IF(c_custkey % 9 = 4, NULL, lower(c_mktsegment) || '.' || c_custkey || '@x.org') AS email",
            "date_add(DATE '2015-01-01', CAST((c_custkey * 37) % 3600 AS INT)) AS hire_date",
        )

    @cached_property
    def proj(self) -> DataFrame:
        return self.scan("supplier").selectExpr(
            "s_suppkey AS project_id",
            "s_name AS project_name",
            "IF(s_suppkey % 10 = 3, NULL, s_nationkey) AS dept_id",
            "CAST((CAST(s_acctbal AS DECIMAL(10,2)) + 1000) * 20 AS DECIMAL(12,2)) AS budget",
            "IF(s_suppkey % 3 = 0, 'Completed', 'Active') AS status",
            "date_add(DATE '2023-01-01', CAST((s_suppkey * 29) % 700 AS INT)) AS end_date",
        )

    @cached_property
    def asg(self) -> DataFrame:
        projects = self.scan("supplier").agg(F.count("*")).scalar()
        return self.scan("orders").select(
            F.expr("o_orderkey AS assignment_id"),
            F.expr("IF(o_custkey % 3 = 0, NULL, o_custkey) AS emp_id"),
            F.try_mod("o_orderkey", projects).alias("project_id"),
            F.expr("CAST(CAST(o_totalprice AS DECIMAL(12,2)) / 4000 AS DECIMAL(5,1)) AS hours_worked"),
            F.expr("CAST(o_orderdate AS DATE) AS assignment_date"),
        )

    @cached_property
    def staff(self) -> DataFrame:
        """Employees with an INTEGER salary, a nullable department name and a status."""
        return self.emp.selectExpr(
            "emp_id",
            "'Customer' AS first_name",
            "substring(emp_name, 10, 9) AS last_name",
            "IF(emp_id % 50 = 7, NULL, segment) AS department",
            "CAST(round(salary) AS INT) AS salary",
            "hire_date",
            "CASE emp_id % 5 WHEN 0 THEN 'Inactive' WHEN 1 THEN 'Terminated'"
            " WHEN 2 THEN 'ACTIVE' WHEN 3 THEN 'Senior' END AS status",
        )

    @cached_property
    def unit(self) -> DataFrame:
        """One department per segment name, plus one that no employee has."""
        names = self.scan("customer").select("c_mktsegment").distinct()
        spare = self.scan("region").agg(F.lit("RESEARCH"))
        return names.union(spare).selectExpr(
            "c_mktsegment AS dept_name",
            "(length(c_mktsegment) - 8) * 60000 AS budget",
            "length(c_mktsegment) + 200 AS manager_id",
        )


# The same frames for the SQL side.
FRAME_SQL = {
    "dept": """
SELECT n_nationkey AS dept_id, n_name AS dept_name, r_name AS location
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "emp": """
SELECT c_custkey AS emp_id, c_name AS emp_name, c_mktsegment AS segment,
  CASE WHEN c_nationkey >= 20 OR c_custkey % 50 = 7 THEN NULL ELSE c_nationkey END AS dept_id,
  CAST(CASE WHEN c_custkey % 40 = 11 THEN NULL
       ELSE (CAST(c_acctbal AS DECIMAL(10,2)) + 1000) * 8 END AS DECIMAL(10,2)) AS salary,
  CASE WHEN c_custkey < 10 THEN NULL ELSE c_custkey // 10 END AS manager_id,
  CASE WHEN c_custkey % 9 = 4 THEN NULL
       ELSE lower(c_mktsegment) || '.' || c_custkey || '@x.org' END AS email,
  DATE '2015-01-01' + CAST((c_custkey * 37) % 3600 AS INTEGER) AS hire_date
FROM customer""",
    "proj": """
SELECT s_suppkey AS project_id, s_name AS project_name,
  CASE WHEN s_suppkey % 10 = 3 THEN NULL ELSE s_nationkey END AS dept_id,
  CAST((CAST(s_acctbal AS DECIMAL(10,2)) + 1000) * 20 AS DECIMAL(12,2)) AS budget,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Completed' ELSE 'Active' END AS status,
  DATE '2023-01-01' + CAST((s_suppkey * 29) % 700 AS INTEGER) AS end_date
FROM supplier""",
    "asg": """
SELECT o_orderkey AS assignment_id,
  CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey END AS emp_id,
  o_orderkey % (SELECT COUNT(*) FROM supplier) AS project_id,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) / 4000 AS DECIMAL(5,1)) AS hours_worked,
  CAST(o_orderdate AS DATE) AS assignment_date
FROM orders""",
    "staff": """
SELECT emp_id, 'Customer' AS first_name, substring(emp_name, 10, 9) AS last_name,
  CASE WHEN emp_id % 50 = 7 THEN NULL ELSE segment END AS department,
  CAST(ROUND(salary) AS INTEGER) AS salary, hire_date,
  CASE emp_id % 5 WHEN 0 THEN 'Inactive' WHEN 1 THEN 'Terminated'
       WHEN 2 THEN 'ACTIVE' WHEN 3 THEN 'Senior' END AS status
FROM emp""",
    "unit": """
SELECT dept_name, CAST((length(dept_name) - 8) * 60000 AS INTEGER) AS budget,
  CAST(length(dept_name) + 200 AS INTEGER) AS manager_id
FROM (SELECT DISTINCT c_mktsegment AS dept_name FROM customer
      UNION ALL SELECT 'RESEARCH')""",
}
_FRAME_NEEDS = {"staff": ["emp"]}


def with_frames(names: str, body: str) -> str:
    """Prefix a SQL body with the frames it reads (space-separated names)."""
    wanted: list[str] = []
    for name in names.split():
        for n in [*_FRAME_NEEDS.get(name, []), name]:
            if n not in wanted:
                wanted.append(n)
    ctes = [f"{n} AS ({FRAME_SQL[n]})" for n in wanted]
    body = body.strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH" and body[4:5].isspace():
        return "WITH " + ",\n".join(ctes) + "," + body[4:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
