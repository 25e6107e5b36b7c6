"""Integrity rules and deletes of parents in the small shop."""

import re

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes, quality
from tablewright.sources.ingest import literal_rows
from tablewright.sources.spec import Check, ForeignKey, references, table
from tablewright.workloads import QUERIES
from tests.fixtures import SHOP, rows, shop


@pytest.fixture(scope="module")
def tables(spark):
    return shop(spark)


def broken_by(spark, tables, name, row):
    grown = {**tables, name: tables[name].unionByName(literal_rows(spark, SHOP[name], [row]))}
    return rows(quality.validate(grown[name], SHOP[name], grown), "rule", "key")


def test_clean_shop(tables):
    for name, df in tables.items():
        assert rows(quality.validate(df, SHOP[name], tables)) == []
        assert quality.enforce(df, SHOP[name], tables) is df


def test_bad_rows(spark, tables):
    assert broken_by(spark, tables, "customers", (6, "Duplicate", "alice.j@example.com", None, "2023-10-01")) == [
        ("customers unique email", "alice.j@example.com")
    ]
    assert broken_by(spark, tables, "products", (6, "Bad Product", "Test", -10, 5)) == [("products check price", "6")]
    assert broken_by(spark, tables, "orders", (106, 1, "2023-10-01", 100, "invalid_status")) == [
        ("orders check status", "106")
    ]
    assert broken_by(spark, tables, "orders", (107, 999, "2023-10-01", 100, "pending")) == [
        ("orders foreign key customer_id", "999")
    ]
    bad = tables["products"].unionByName(literal_rows(spark, SHOP["products"], [(1, None, None, -10, None)]))
    with pytest.raises(quality.IntegrityError):
        quality.enforce(bad, SHOP["products"])
    assert rows(quality.validate(bad, SHOP["products"]), "rule") == [
        ("products check price",), ("products primary key",), ("products.name not null",),
        ("products.stock_quantity not null",),
    ]


def test_nulls_pass_checks_but_not_keys(spark):
    spec = table("t", "a int, b int", primary_key=("a",), unique=(("b",),), checks=(Check("b", "b > 0"),))
    df = spark.createDataFrame([(1, None), (2, None), (None, 1)], spec.schema)
    assert rows(quality.validate(df, spec), "rule", "key") == [("t.a not null", "NULL")]


def test_composite_keys(spark):
    spec = table("t", "a int, b int", primary_key=("a", "b"))
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], spec.schema)
    assert rows(quality.validate(df, spec)) == [
        ("t primary key", "1|1", "2"), ("t.a not null", "NULL|1", "NULL"), ("t.a not null", "NULL|1", "NULL"),
    ]


def test_composite_foreign_key(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 9)], "a int, b int")
    parent = spark.createDataFrame([(1, 1)], "x int, y int")
    fk = ForeignKey(("a", "b"), "p", ("x", "y"))
    assert rows(quality.dangling(child, fk, parent, "fk")) == [("fk", "1|2", "2")]


def test_lengths_and_precision(spark):
    spec = table("t", "k int, v varchar(3), c char(3), n numeric(4,1)", primary_key=("k",))
    df = spark.createDataFrame(
        [(1, "abc", "abc  ", "999.94"), (2, "abcd", "abcd", "999.95"), (3, "ab  ", None, None)],
        "k int, v string, c string, n string",
    ).withColumn("n", F.col("n").cast("decimal(10,3)"))
    assert rows(quality.validate(df, spec), "rule", "key") == [
        ("t.c char(3)", "2"), ("t.n numeric(4,1)", "2"), ("t.v varchar(3)", "2"), ("t.v varchar(3)", "3"),
    ]


def test_delete_order_cascades(tables):
    gone = tables["orders"].filter("order_id = 101")
    kept, lost = changes.cascade(tables["details"], "order_id", gone, "order_id")
    assert rows(lost, "order_detail_id") == [(1,), (2,)] and kept.count() == 5


def test_delete_product_is_refused(tables):
    doomed = F.col("product_id") == 1
    after = changes.delete_restricted(tables["products"], doomed, "product_id", tables["details"], "product_id")
    assert after.count() == 5
    stuck = changes.blockers(tables["products"].filter(doomed), "product_id", tables["details"], "product_id")
    assert rows(stuck, "product_id") == [(1,)]
    unused = tables["details"].filter("product_id <> 1")
    assert changes.delete_restricted(tables["products"], doomed, "product_id", unused, "product_id").count() == 4


def test_delete_customer_sets_null(tables):
    gone = tables["customers"].filter("customer_id = 1")
    after = changes.set_null(tables["orders"], "customer_id", gone, "customer_id")
    assert rows(after, "order_id", "customer_id") == [(101, None), (102, 2), (103, 3), (104, None), (105, 4)]


def test_check_option(spark):
    new = spark.createDataFrame([(7, 103), (8, 101), (9, None)], "emp_id int, dept_id int")
    outside = quality.outside_view(new, F.col("dept_id") == 101)
    assert rows(outside, "emp_id") == [(7,), (9,)]
    violations = outside.select(F.lit("it_employees").alias("rule"), F.col("emp_id").alias("key"), "dept_id")
    with pytest.raises(quality.IntegrityError):
        quality.refuse(new, violations.withColumnRenamed("dept_id", "detail"))


def test_deletes_follow_the_declared_rules(tables):
    schema = {name: (df, SHOP[name]) for name, df in tables.items()}
    after = changes.delete_parents(schema, "orders", F.col("order_id") == 101)
    assert {n: df.count() for n, df in after.items()} == {"customers": 5, "products": 5, "orders": 4, "details": 5}
    after = changes.delete_parents(schema, "customers", F.col("customer_id") == 1)
    assert rows(after["orders"], "order_id", "customer_id") == [(101, None), (102, 2), (103, 3), (104, None), (105, 4)]
    assert after["details"].count() == 7
    with pytest.raises(quality.IntegrityError, match="details still refers to products 1"):
        changes.delete_parents(schema, "products", F.col("product_id") == 1)


@pytest.mark.parametrize(("rule", "refused"), [("no action", False), ("restrict", True)])
def test_no_action_looks_at_remaining_children(spark, rule, refused):
    """b goes with a, and c with b; c also refers to a directly."""
    a = table("a", "a int", primary_key=("a",))
    b = table("b", "b int, a int", primary_key=("b",), foreign_keys=(references("a", a, "cascade"),))
    c = table("c", "c int, a int, b int", foreign_keys=(references("b", b, "cascade"), references("a", a, rule)))
    schema = {
        "c": (spark.createDataFrame([(1, 1, 10), (2, 2, 20), (3, 2, 10)], c.schema), c),
        "b": (spark.createDataFrame([(10, 1), (20, 2)], b.schema), b),
        "a": (spark.createDataFrame([(1,), (2,)], a.schema), a),
    }
    if refused:
        with pytest.raises(quality.IntegrityError):
            changes.delete_parents(schema, "a", F.col("a") == 1)
    else:
        after = changes.delete_parents(schema, "a", F.col("a") == 1)
        assert rows(after["b"]) == [(20, 2)] and rows(after["c"]) == [(2, 2, 20)]


def test_one_pass_validation_equals_the_rules_one_by_one(spark):
    """Hot and NULL keys, text keys, composite keys, equal rows, references to a unique key and to the own table."""
    a = table(
        "a", "id bigint!, code varchar(3), boss int, x numeric(4,1)", primary_key=("id",), unique=(("code",),),
        checks=(Check("x", "x >= 0"),), foreign_keys=(ForeignKey(("boss",), "a", ("id",)),),
    )
    b = table(
        "b", "a_id int, line int, code text, u text, v text, w int", primary_key=("a_id", "line"), unique=(("u", "v"), ("w",)),
        foreign_keys=(references("a_id", a), ForeignKey(("code",), "a", ("code",)), ForeignKey(("w",), "b", ("w",))),
    )
    c = table("c", "u text, v text, n int", foreign_keys=(ForeignKey(("u", "v"), "b", ("u", "v")),))
    rows_a = [(1, "x", None, 1.0), (1, "y", 2, -1.0), (2, "y", 9, None), (None, "long", None, -3.0), (None, "long", None, -3.0), (4, None, 1, 5.0)]
    rows_b = [(1, 1, "x", "p", "q", 1)] * 2 + [(7, 1, "z", "p|q", None, 2), (7, None, None, "p", "q|r", 3), (7, None, "z", "p|q", "r", 3)]
    rows_b += [(None, 2, "y", None, None, None), (2, 2, "y", "p", "q|r", 4)]
    rows_c = [("p", "q", 1), ("p|q", "r", 1), ("p", "q|r", 2), ("no", "such", 1), ("no", "such", 2), (None, "q", 1), ("p|q|r", "", 1)]
    frames = [
        spark.createDataFrame(rows_a, "id long, code string, boss int, x double").withColumn("x", F.col("x").cast("decimal(6,1)")),
        spark.createDataFrame(rows_b, "a_id int, line int, code string, u string, v string, w int"),
        spark.createDataFrame(rows_c, "u string, v string, n int"),
    ]
    tables = dict(zip("abc", zip(frames, (a, b, c))))
    parents = dict(zip("abc", frames))
    want = [r for df, spec in tables.values() for r in rows(quality.validate(df, spec, parents), "rule", "key", "detail")]
    got = rows(quality.validate_all(tables), "rule", "key", "detail")
    assert sorted(got, key=repr) == sorted(want, key=repr) and len({r[0] for r in want}) > 9


def test_the_report_reads_each_table_once(spark):
    found = QUERIES["dq_17_report"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\] parquet", plan)) == 4
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_the_report_interprets_nothing_for_each_row(spark):
    """A lambda in the array that a row is exploded to takes the whole of it out of the compiled code."""
    plan = QUERIES["dq_17_report"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode") >= 9 and "lambda" not in plan
