"""Integrity rules over whole tables with faults planted by a fixed rule on the values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import quality
from tablewright.sources.spec import Check, ForeignKey, TableSpec, references, table
from tablewright.sources.tables import Tables, day
from tablewright.workloads import fixed
from tablewright.workloads.registry import query


def _when(condition: str, value) -> F.Column:
    return F.when(F.expr(condition), value)


def _rule(name: str, is_broken: str, detail: str, key: str, source: str) -> str:
    """The SQL of one per-row rule."""
    return (
        f"SELECT '{name}' AS rule, CAST({key} AS VARCHAR) AS key, CAST({detail} AS VARCHAR) AS detail "
        f"FROM {source} WHERE {is_broken}"
    )


def _duplicates_sql(name: str, columns: str, source: str) -> str:
    parts = [c.strip() for c in columns.split(",")]
    present = " AND ".join(f"{c} IS NOT NULL" for c in parts)
    key = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in parts)
    return (
        f"SELECT '{name}' AS rule, {key} AS key, CAST(COUNT(*) AS VARCHAR) AS detail "
        f"FROM {source} WHERE {present} GROUP BY {columns} HAVING COUNT(*) > 1"
    )


def _dangling_sql(name: str, column: str, child: str, parent: str, parent_column: str) -> str:
    return (
        f"SELECT '{name}' AS rule, CAST({column} AS VARCHAR) AS key, CAST(COUNT(*) AS VARCHAR) AS detail "
        f"FROM {child} WHERE {column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} WHERE {parent_column} = {column}) GROUP BY {column}"
    )


@query(
    "dq_01_not_null",
    " UNION ALL ".join(_rule(f"{c} not null", f"{c} IS NULL", "'NULL'", "emp_id", "emp") for c in ("dept_id", "salary", "email")),
    "emp",
)
def not_null(t: Tables) -> DataFrame:
    rules = {f"{c} not null": (F.col(c).isNull(), F.lit("NULL")) for c in ("dept_id", "salary", "email")}
    return quality.row_rules(t.emp, rules, ["emp_id"])


@query(
    "dq_02_range",
    _rule("salary range", "NOT (salary > 10000 AND salary <= 80000)", "salary", "emp_id", "emp"),
    "emp",
)
def range_(t: Tables) -> DataFrame:
    ok = (F.col("salary") > 10000) & (F.col("salary") <= 80000)
    return quality.row_rules(t.emp, {"salary range": (quality.broken(ok), F.col("salary"))}, ["emp_id"])


@query(
    "dq_03_between",
    _rule("quantity", "NOT (l_quantity BETWEEN 1 AND 45)", "CAST(l_quantity AS DECIMAL(10,1))",
          "l_orderkey || '|' || l_linenumber", "lineitem"),
)
def between(t: Tables) -> DataFrame:
    rule = (quality.broken(F.col("l_quantity").between(1, 45)), F.col("l_quantity").cast("decimal(10,1)"))
    return quality.row_rules(t.scan("lineitem"), {"quantity": rule}, ["l_orderkey", "l_linenumber"])


_CATALOG_SQL = """WITH catalog AS (SELECT p_partkey AS product_id,
  CAST(p_retailprice AS DECIMAL(10,2)) AS regular_price,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) * (p_size % 12) * 0.1 AS DECIMAL(12,2)) AS discount_price FROM part) """


@query(
    "dq_04_named_check",
    _CATALOG_SQL
    + _rule("valid_discount",
            "NOT (regular_price > 0 AND discount_price > 0 AND discount_price < regular_price)",
            "discount_price", "product_id", "catalog"),
)
def named_check(t: Tables) -> DataFrame:
    regular = F.col("p_retailprice").cast("decimal(10,2)")
    catalog = t.scan("part").select(
        F.col("p_partkey").alias("product_id"),
        regular.alias("regular_price"),
        (regular * (F.col("p_size") % 12) * F.expr("0.1")).cast("decimal(12,2)").alias("discount_price"),
    )
    ok = F.expr("regular_price > 0 AND discount_price > 0 AND discount_price < regular_price")
    return quality.row_rules(
        catalog, {"valid_discount": (quality.broken(ok), F.col("discount_price"))}, ["product_id"]
    )


_STAY_SQL = """WITH stay AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS check_in,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 15 - 2 AS INTEGER) END AS check_out
  FROM orders) """


def _stay(t: Tables) -> DataFrame:
    check_in = F.col("o_orderdate").cast("date")
    return t.scan("orders").select(
        F.col("o_orderkey").alias("id"),
        check_in.alias("check_in"),
        _when("o_orderkey % 4 <> 0", F.date_add(check_in, F.expr("cast(o_custkey % 15 - 2 as int)"))).alias(
            "check_out"
        ),
    )


@query(
    "dq_05_date_order",
    _STAY_SQL + _rule("check_out after check_in", "NOT check_out > check_in", "check_out", "id", "stay"),
)
def date_order(t: Tables) -> DataFrame:
    rule = (quality.broken(F.col("check_out") > F.col("check_in")), F.col("check_out"))
    return quality.row_rules(_stay(t), {"check_out after check_in": rule}, ["id"])


@query(
    "dq_06_or_null",
    _STAY_SQL
    + _rule("returned", "NOT (check_out >= check_in OR check_out IS NULL)", "check_out", "id", "stay"),
)
def or_null(t: Tables) -> DataFrame:
    ok = (F.col("check_out") >= F.col("check_in")) | F.col("check_out").isNull()
    return quality.row_rules(_stay(t), {"returned": (quality.broken(ok), F.col("check_out"))}, ["id"])


@query(
    "dq_07_domain",
    _rule("status", "o_orderstatus NOT IN ('O', 'F')", "o_orderstatus", "o_orderkey", "orders"),
)
def domain(t: Tables) -> DataFrame:
    rule = (quality.broken(F.col("o_orderstatus").isin("O", "F")), F.col("o_orderstatus"))
    return quality.row_rules(t.scan("orders"), {"status": rule}, ["o_orderkey"])


@query(
    "dq_08_current_date",
    " UNION ALL ".join([
        _rule("not in the future", "NOT hire_date <= DATE '2022-06-30'", "hire_date", "emp_id", "emp"),
        _rule("year", "NOT (year(hire_date) > 2015 AND year(hire_date) <= year(DATE '2022-06-30'))",
              "year(hire_date)", "emp_id", "emp"),
    ]),
    "emp",
)
def current_date(t: Tables) -> DataFrame:
    today, year = day("2022-06-30"), F.year("hire_date")
    rules = {
        "not in the future": (quality.broken(F.col("hire_date") <= today), F.col("hire_date")),
        "year": (quality.broken((year > 2015) & (year <= F.year(today))), year),
    }
    return quality.row_rules(t.emp, rules, ["emp_id"])


@query(
    "dq_09_unique",
    """WITH users AS (SELECT CASE WHEN emp_id % 9 = 4 THEN NULL
         ELSE lower(segment) || '.' || emp_id // 2 END AS email FROM emp) """
    + _duplicates_sql("users unique email", "email", "users"),
    "emp",
)
def unique(t: Tables) -> DataFrame:
    email = F.concat_ws(".", F.lower("segment"), F.expr("emp_id div 2"))
    users = t.emp.select(_when("emp_id % 9 <> 4", email).alias("email"))
    return quality.duplicates(users, ["email"], "users unique email")


_LINE_SQL = """WITH line AS (SELECT l_orderkey, CASE WHEN l_partkey % 6 = 5 THEN NULL ELSE l_linenumber END
  AS l_linenumber FROM lineitem) """


def _line(t: Tables) -> DataFrame:
    return t.scan("lineitem").select(
        "l_orderkey", _when("l_partkey % 6 <> 5", F.col("l_linenumber")).alias("l_linenumber")
    )


@query("dq_10_composite_unique", _LINE_SQL + _duplicates_sql("line", "l_orderkey, l_linenumber", "line"))
def composite_unique(t: Tables) -> DataFrame:
    return quality.duplicates(_line(t), ["l_orderkey", "l_linenumber"], "line")


_KEYED_SQL = """WITH keyed AS (SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL
  WHEN c_custkey % 89 = 1 THEN c_custkey - 1 ELSE c_custkey END AS id FROM customer) """


@query(
    "dq_11_primary_key",
    _KEYED_SQL
    + _rule("keyed.id not null", "id IS NULL", "'NULL'", "'NULL'", "keyed")
    + " UNION ALL "
    + _duplicates_sql("keyed primary key", "id", "keyed"),
)
def primary_key(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    keyed = t.scan("customer").select(
        F.when(key % 97 == 0, None).when(key % 89 == 1, key - 1).otherwise(key).alias("id")
    )
    return quality.validate(keyed, table("keyed", "id bigint", primary_key=("id",)))


@query(
    "dq_12_composite_primary_key",
    _LINE_SQL
    + _rule("line.l_orderkey not null", "l_orderkey IS NULL", "'NULL'", "'NULL'", "line")
    + " UNION ALL "
    + _rule("line.l_linenumber not null", "l_linenumber IS NULL", "'NULL'", "l_orderkey || '|NULL'", "line")
    + " UNION ALL "
    + _duplicates_sql("line primary key", "l_orderkey, l_linenumber", "line"),
)
def composite_primary_key(t: Tables) -> DataFrame:
    spec = table("line", "l_orderkey bigint, l_linenumber int", primary_key=("l_orderkey", "l_linenumber"))
    return quality.validate(_line(t), spec)


_BUYER_SQL = """WITH buys AS (SELECT CASE WHEN o_orderkey % 50 = 9 THEN NULL
  WHEN o_orderkey % 97 = 0 THEN -1 - o_custkey ELSE o_custkey END AS buyer FROM orders) """


@query("dq_13_foreign_key", _BUYER_SQL + _dangling_sql("buyer", "buyer", "buys", "customer", "c_custkey"))
def foreign_key(t: Tables) -> DataFrame:
    key, buyer = F.col("o_orderkey"), F.col("o_custkey")
    buys = t.scan("orders").select(
        F.when(key % 50 == 9, None).when(key % 97 == 0, -1 - buyer).otherwise(buyer).alias("buyer")
    )
    fk = ForeignKey(("buyer",), "customer", ("c_custkey",))
    return quality.dangling(buys, fk, t.scan("customer"), "buyer")


@query(
    "dq_14_length",
    " UNION ALL ".join([
        _rule("varchar(10)", "length(p_name) > 10", "p_name", "p_partkey", "part"),
        _rule("char(6)", "length(rtrim(p_type)) > 6", "p_type", "p_partkey", "part"),
    ]),
)
def length(t: Tables) -> DataFrame:
    part = t.scan("part").withColumn("padded", F.rpad("p_type", 20, " "))
    rules = {
        "varchar(10)": (quality.too_long("p_name", "varchar(10)"), F.col("p_name")),
        "char(6)": (quality.too_long("padded", "char(6)"), F.col("p_type")),
    }
    return quality.row_rules(part, rules, ["p_partkey"])


@query(
    "dq_15_precision",
    _rule("numeric(7,2)", "TRY_CAST(price AS DECIMAL(7,2)) IS NULL AND price IS NOT NULL", "price", "o_orderkey",
          "(SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders)"),
)
def precision(t: Tables) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(12,2)")
    rules = {"numeric(7,2)": (quality.does_not_fit(price, "decimal(7,2)"), price)}
    return quality.row_rules(t.scan("orders"), rules, ["o_orderkey"])


@query("dq_16_check_option", "SELECT * FROM emp WHERE (dept_id = 1) IS NOT TRUE", "emp")
def check_option(t: Tables) -> DataFrame:
    return quality.outside_view(t.emp, F.col("dept_id") == 1)


# --- the shop: customers, products, orders and order lines ----------------------------

SHOP_CUSTOMERS = table(
    "customers",
    "customer_id bigint!, name varchar(18)!, email text!, phone text",
    primary_key=("customer_id",),
    unique=(("email",),),
)
SHOP_PRODUCTS = table(
    "products",
    "product_id bigint!, name text!, price numeric(12,2)!, stock int!",
    primary_key=("product_id",),
    checks=(Check("price", "price >= 0"), Check("stock", "stock >= 0")),
)
SHOP_ORDERS = table(
    "orders",
    "order_id bigint!, customer_id bigint, order_date date!, total numeric(12,2), status text!",
    primary_key=("order_id",),
    checks=(
        Check("total", "total >= 0"),
        Check("status", f"status IN {fixed.ORDER_STATUSES}"),
    ),
    foreign_keys=(references("customer_id", SHOP_CUSTOMERS, "set null"),),
)
SHOP_LINES = table(
    "lines",
    "order_id bigint, line int, product_id bigint, quantity int!, price numeric(12,2)!",
    primary_key=("order_id", "line"),
    checks=(Check("quantity", "quantity > 0"), Check("price", "price >= 0")),
    foreign_keys=(
        references("order_id", SHOP_ORDERS, "cascade"),
        references("product_id", SHOP_PRODUCTS, "restrict"),
    ),
)


def shop(t: Tables) -> dict[str, tuple[DataFrame, TableSpec]]:
    customers = t.scan("customer").selectExpr(
        "c_custkey AS customer_id",
        "CASE WHEN c_custkey % 101 = 5 THEN c_name || '!' ELSE c_name END AS name",
        "CASE WHEN c_custkey % 83 = 2 THEN NULL WHEN c_custkey % 71 = 3 THEN 'c' || (c_custkey - 1)"
        " ELSE 'c' || c_custkey END AS email",
        "CAST(NULL AS STRING) AS phone",
    )
    products = t.scan("part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS name",
        "CAST(CASE WHEN p_partkey % 67 = 0 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(12,2)) AS price",
        "CASE WHEN p_partkey % 59 = 1 THEN NULL ELSE p_size - 2 END AS stock",
    )
    orders = t.scan("orders").selectExpr(
        "o_orderkey AS order_id",
        "CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_custkey WHEN o_orderkey % 50 = 9 THEN NULL"
        " ELSE o_custkey END AS customer_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS total",
        "CASE o_orderstatus WHEN 'O' THEN 'shipped' WHEN 'F' THEN 'delivered' ELSE 'pend' END AS status",
    )
    lines = t.scan("lineitem").selectExpr(
        "CASE WHEN l_partkey % 13 = 0 THEN l_orderkey + 100000000000 ELSE l_orderkey END AS order_id",
        "l_linenumber AS line",
        "CASE WHEN l_suppkey % 19 = 0 THEN -1 - l_partkey ELSE l_partkey END AS product_id",
        "CAST(l_quantity AS INT) - 1 AS quantity",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
    )
    return {
        "customers": (customers, SHOP_CUSTOMERS),
        "products": (products, SHOP_PRODUCTS),
        "orders": (orders, SHOP_ORDERS),
        "lines": (lines, SHOP_LINES),
    }


_SHOP_SQL = """WITH
customers AS (SELECT c_custkey AS customer_id,
  CASE WHEN c_custkey % 101 = 5 THEN c_name || '!' ELSE c_name END AS name,
  CASE WHEN c_custkey % 83 = 2 THEN NULL WHEN c_custkey % 71 = 3 THEN 'c' || (c_custkey - 1)
       ELSE 'c' || c_custkey END AS email FROM customer),
products AS (SELECT p_partkey AS product_id,
  CAST(CASE WHEN p_partkey % 67 = 0 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(12,2)) AS price,
  CASE WHEN p_partkey % 59 = 1 THEN NULL ELSE p_size - 2 END AS stock FROM part),
shop_orders AS (SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_custkey WHEN o_orderkey % 50 = 9 THEN NULL ELSE o_custkey END AS customer_id,
  CASE o_orderstatus WHEN 'O' THEN 'shipped' WHEN 'F' THEN 'delivered' ELSE 'pend' END AS status FROM orders),
lines AS (SELECT
  CASE WHEN l_partkey % 13 = 0 THEN l_orderkey + 100000000000 ELSE l_orderkey END AS order_id,
  l_linenumber AS line,
  CASE WHEN l_suppkey % 19 = 0 THEN -1 - l_partkey ELSE l_partkey END AS product_id,
  CAST(l_quantity AS INTEGER) - 1 AS quantity FROM lineitem) """


def _quoted(condition: str) -> str:
    return "'" + condition.replace("'", "''") + "'"


@query(
    "dq_17_report",
    _SHOP_SQL
    + " UNION ALL ".join([
        _rule("customers.name varchar(18)", "length(name) > 18", "name", "customer_id", "customers"),
        _rule("customers.email not null", "email IS NULL", "'NULL'", "customer_id", "customers"),
        _duplicates_sql("customers unique email", "email", "customers"),
        _rule("products check price", "NOT price >= 0", "'price >= 0'", "product_id", "products"),
        _rule("products.stock not null", "stock IS NULL", "'NULL'", "product_id", "products"),
        _rule("products check stock", "NOT stock >= 0", "'stock >= 0'", "product_id", "products"),
        _rule("orders check status", f"status NOT IN {fixed.ORDER_STATUSES}",
              _quoted(f"status IN {fixed.ORDER_STATUSES}"), "order_id", "shop_orders"),
        _dangling_sql("orders foreign key customer_id", "shop_orders.customer_id", "shop_orders",
                      "customers", "customers.customer_id"),
        _duplicates_sql("lines primary key", "order_id, line", "lines"),
        _rule("lines check quantity", "NOT quantity > 0", "'quantity > 0'", "order_id || '|' || line", "lines"),
        _dangling_sql("lines foreign key order_id", "lines.order_id", "lines", "shop_orders", "shop_orders.order_id"),
        _dangling_sql("lines foreign key product_id", "lines.product_id", "lines", "products", "products.product_id"),
    ]),
)
def report(t: Tables) -> DataFrame:
    return quality.validate_all(shop(t))
