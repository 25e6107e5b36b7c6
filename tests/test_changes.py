"""Inserts, updates and deletes: one table through a whole script of changes."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes, subqueries
from tablewright.operators.aggregates import per_key
from tablewright.operators.quality import IntegrityError
from tablewright.operators.ranking import top_key
from tablewright.plans.hierarchy import below, levels
from tablewright.plans.views import TableView
from tablewright.sources import ingest
from tablewright.sources.spec import DEFAULT, Check, ForeignKey, SetDefault, alter, references, table
from tablewright.sources.stored import StoredTable, empty_like
from tests.fixtures import rows

STAFF = table(
    "employees",
    "emp_id int, first_name varchar(50), last_name varchar(50), department varchar(50), salary int,"
    "hire_date date, status varchar(20) = 'ACTIVE'",
    primary_key=("emp_id",),
)
UNITS = table("departments", "dept_id int, dept_name varchar(50), budget int, manager_id int")
TODAY = dt.date(2024, 5, 6)
name_pay = ["first_name", "salary"]


def insert(df, spec, columns, *values):
    return df.unionByName(ingest.literal_rows(df.sparkSession, spec, values, columns))


def test_script_of_changes(spark):
    # first rows: keys given by hand, then keys handed out from 1
    named = ["emp_id", "first_name", "last_name", "department"]
    e = insert(
        STAFF.empty(spark), STAFF, named,
        (100, "Era", "Rakhan", "SITE"), (101, "Abu", "Debara", "ISE"), (102, "Alihan", "Sarkyt", "SEPI"),
    )
    assert rows(e, "emp_id", "salary", "status") == [(i, None, "ACTIVE") for i in (100, 101, 102)]
    e = insert(e, STAFF, [*named, "salary", "status"], (1, "Magripa", "Bakhyt", "Marketing", DEFAULT, DEFAULT))
    assert rows(e.filter("emp_id = 1"), "salary", "status") == [(None, "ACTIVE")]
    e = insert(
        e, STAFF, [*named, "salary", "hire_date"],
        (2, "Arman", "Parasat", "IT", F.expr("50000 * 1.1"), F.lit(TODAY)),
    )
    arman = F.col("first_name") == "Arman"
    assert rows(e.filter(arman), "salary", "hire_date", "status") == [(55000, TODAY, "ACTIVE")]

    units = insert(
        UNITS.empty(spark), UNITS, None, (1, "SITE", 10000, 201), (2, "ISE", 500000, 202), (3, "SEPI", 80000, 203)
    )

    # an empty clone, filled by a query, does not follow the table
    clone = empty_like(e)
    assert clone.schema == e.schema and clone.count() == 0
    clone = ingest.append_by_position(clone, e.filter("department = 'IT'"), STAFF)

    e = changes.update(e, {"salary": F.col("salary") * F.expr("1.10")})
    assert rows(e, "salary").count((None,)) == 4 and rows(e.filter(arman), "salary") == [(60500,)]
    assert rows(clone, *name_pay) == [("Arman", 55000)]

    before = rows(e)
    e = changes.update(
        e, {"status": F.lit("Senior")}, (F.col("salary") > 60000) & (F.col("hire_date") < F.lit("2020-01-01"))
    )
    assert rows(e) == before

    pay = F.col("salary")
    e = changes.update(
        e,
        {"department": F.when(pay > 80000, "Management").when(pay.between(50000, 80000), "Senior").otherwise("Junior")},
    )
    assert sorted(rows(e, "department")) == [("Junior",)] * 4 + [("Senior",)]

    e, spec = alter(e, STAFF, SetDefault("department", "General"))
    assert spec["department"].default == "General"
    before = rows(e)
    assert rows(changes.update_to_default(e, spec, "department", F.col("status") == "Inactive")) == before

    mean = per_key(e, "department", new=F.round(F.avg("salary") * F.expr("1.20"))).withColumnRenamed(
        "department", "dept_name"
    )
    units = changes.update_from_lookup(units, "dept_name", mean, "budget", "new")
    assert rows(units, "budget") == [(None,)] * 3

    for where in (
        F.col("status") == "Terminated",
        (pay < 40000) & (F.col("hire_date") > F.lit("2023-01-01")) & F.col("department").isNull(),
        F.col("hire_date") < F.lit("2020-01-01"),
        F.col("status") == "Inactive",
    ):
        assert rows(changes.delete(e, where)) == before

    # a new row without salary and department
    e = insert(e, spec, ["emp_id", "first_name", "last_name", "salary", "department"], (3, "Make", "Bakha", None, None))
    e = changes.update(e, {"department": F.lit("Unassigned")}, F.col("department").isNull())
    assert rows(e.filter("emp_id = 3"), "department") == [("Unassigned",)]
    e = e.dropna(how="any", subset=["salary", "department"])
    assert rows(e, *name_pay) == [("Arman", 60500)]

    e = insert(e, spec, [*named, "salary"], (4, "Robert", "Johnson", "IT", 60000))
    it = F.col("department") == "IT"
    audit = e.filter(it).select("emp_id", pay.alias("old"), (pay + 5000).alias("new"))
    assert rows(audit) == [(4, 60000, 65000)]
    e = changes.update(e, {"salary": pay + 5000}, it)
    assert rows(e, *name_pay) == [("Arman", 60500), ("Robert", 65000)]

    probe = e.filter("first_name = 'John' AND last_name = 'Doe'")
    constants = {"first_name": "Arman", "last_name": "Parasat", "department": "IT", "salary": 55000}
    assert ingest.insert_if_absent(e, probe, spec, **constants).count() == 3
    e = ingest.append_copies_unless(e, probe, spec, **constants)
    assert rows(e, *name_pay) == [("Arman", 55000), ("Arman", 55000), ("Arman", 60500), ("Robert", 65000)]

    e = subqueries.single_value(e, "department", units, "dept_name", "budget", "budget")
    raised = F.when(F.col("budget") > 100000, pay * F.expr("1.10")).otherwise(pay * F.expr("1.05"))
    e = changes.update(e, {"salary": raised}).drop("budget")
    assert rows(e, *name_pay) == [("Arman", 57750), ("Arman", 57750), ("Arman", 63525), ("Robert", 68250)]

    five = [
        ("Aruzhan", "Temir", "Engineering", 65000), ("Bakhyt", "Nurlan", "Marketing", 48000),
        ("Camila", "Zhan", "Finance", 72000), ("Dias", "Oral", "HR", 42000), ("Emina", "Kairat", "Engineering", 68000),
    ]
    e = insert(e, spec, ["first_name", "last_name", "department", "salary"], *five)
    names = F.col("first_name").isin([f[0] for f in five])
    e = changes.update(e, {"salary": pay * F.expr("1.10")}, names)
    assert rows(e.filter(names), *name_pay) == [
        ("Aruzhan", 71500), ("Bakhyt", 52800), ("Camila", 79200), ("Dias", 46200), ("Emina", 74800),
    ]


def test_update_by_key_sets_null(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k long, v long")
    news = spark.createDataFrame([(1, 11), (2, None)], "k long, v long")
    assert rows(changes.update_by_key(df, "k", news, "v")) == [(1, 11), (2, None), (3, 30)]


def test_update_sees_the_old_row(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(changes.update(df, {"a": F.col("b"), "b": F.col("a")})) == [(2, 1)]


def test_move_loses_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "k long, v long")
    moved, kept = changes.move(df, F.col("v") > 6, StoredTable.fresh(spark, "t"))
    assert rows(moved) == [(3, 9)] and rows(kept) == [(1, 5), (2, None)]
    assert moved.schema == df.schema


def test_arity_and_unknown_columns(spark):
    with pytest.raises(ValueError, match="6 values for 7 columns"):
        ingest.literal_rows(spark, STAFF, [(1, "a", "b", "c", 1, None)])
    with pytest.raises(ValueError, match="no column"):
        ingest.append(STAFF.empty(spark), spark.range(1), STAFF)
    with pytest.raises(ValueError, match="1 values"):
        ingest.append_by_position(STAFF.empty(spark), spark.range(1), STAFF)


def test_a_repeated_key_fails_the_update(spark):
    df = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    news = spark.createDataFrame([(1, 11), (1, 12), (3, 1), (3, 2)], "k int, v int")
    for changed in (changes.update_by_key(df, "k", news, "v"), changes.update_from_lookup(df, "k", news, "v", "v")):
        with pytest.raises(Exception, match="more than one row for 1"):
            changed.collect()
    assert rows(changes.update_by_key(df.filter("k = 2"), "k", news, "v")) == [(2, 20)]


def test_rows_without_a_key_get_one(spark):
    spec = table("t", "id serial, name text", primary_key=("id",))
    old = spec.empty(spark)
    new = spark.createDataFrame([("b", 2), ("a", 1)], "name string, arrival long")
    first = ingest.append_keyed(old, new, spec, "arrival")
    assert sorted(rows(first)) == [(1, "a"), (2, "b")]
    assert sorted(rows(ingest.append_keyed(first, new, spec, "arrival")))[2:] == [(3, "a"), (4, "b")]
    for wrong, message in ((new.withColumn("arrival", F.lit(None).cast("long")), "is NULL"), (new.union(new), "repeats")):
        with pytest.raises(Exception, match=message):
            ingest.append_keyed(old, wrong, spec, "arrival").collect()


PEOPLE = table(
    "people", "id bigint, name varchar(6), boss bigint, pay decimal(6,2) = 1", primary_key=("id",), unique=(("name",),),
    checks=(Check("pay", "pay > 0"),), foreign_keys=(ForeignKey(("boss",), "people", ("id",), "cascade"),),
)


def people(spark, *bosses):
    rows_ = [(i, f"p{i}", boss, 1) for i, boss in enumerate(bosses)]
    return ingest.literal_rows(spark, PEOPLE, rows_)


def test_cascade_along_a_hierarchy_and_a_ring(spark):
    df = people(spark, None, 0, 1, 2, 3, None, 5, 8, 7, None, 9, 11)
    left = lambda where: [r[0] for r in rows(changes.delete_parents({"people": (df, PEOPLE)}, "people", where)["people"])]
    assert left(F.col("id") == 1) == [0, 5, 6, 7, 8, 9, 10, 11]
    assert left(F.col("id") == 7) == [0, 1, 2, 3, 4, 5, 6, 9, 10, 11]  # 7 and 8 report to each other
    assert left(F.col("id") == 11) == list(range(11))  # reports to itself
    assert left(F.col("id").isin(0, 9)) == [5, 6, 7, 8, 11]
    assert left(F.col("id") == 99) == list(range(12)) and left(F.lit(True)) == []


def test_a_chain_of_10000_levels(spark, monkeypatch):
    rounds = []
    write = StoredTable.write
    monkeypatch.setattr(StoredTable, "write", lambda self, *a, **k: rounds.append(self.name) or write(self, *a, **k))
    df = spark.range(10000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("boss"))
    got = levels(df, "id", "boss")
    assert got.filter("top = 0 AND depth = id").count() == 10000 and len(rounds) <= 20
    rounds.clear()
    assert sorted(r[0] for r in rows(below(df, "id", "boss", spark.range(7000, 7001)))) == list(range(7000, 10000))
    assert len(rounds) <= 20


def test_levels_of_rings_and_strangers(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 99), (5, 6), (6, 5), (7, 6), (8, 8)], "id long, boss long")
    assert sorted(rows(levels(df, "id", "boss")), key=lambda r: r[0]) == [
        (1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 4, 0), (5, None, None), (6, None, None), (7, None, None), (8, None, None)
    ]
    assert levels(df.filter("id < 0"), "id", "boss").count() == 0


def test_cascade_between_two_tables_in_a_cycle(spark):
    a = table("a", "a int, b int", primary_key=("a",), foreign_keys=(ForeignKey(("b",), "b", ("b",), "cascade"),))
    b = table("b", "b int, a int", primary_key=("b",), foreign_keys=(ForeignKey(("a",), "a", ("a",), "cascade"),))
    c = table("c", "a int", foreign_keys=(references("a", a, "set null"),))
    made = {
        "a": (ingest.literal_rows(spark, a, [(1, None), (2, 10), (3, 11)]), a),
        "b": (ingest.literal_rows(spark, b, [(10, 1), (11, 2), (12, None)]), b),
        "c": (ingest.literal_rows(spark, c, [(3,), (None,)]), c),
    }
    after = changes.delete_parents(made, "a", F.col("a") == 1)
    assert rows(after["a"]) == [] and rows(after["b"]) == [(12, None)] and rows(after["c"]) == [(None,), (None,)]
    with pytest.raises(ValueError, match="primary key"):
        changes.delete_parents({**made, "a": (made["a"][0], replace(a, primary_key=()))}, "a", F.col("a") == 1)


def test_insert_keeps_the_rules(spark):
    store = StoredTable.fresh(spark, "t")
    add = lambda *values: changes.insert(store, ingest.literal_rows(spark, PEOPLE, values), PEOPLE)
    assert add((1, "a", None, 1), (2, "b", 1, 1)) == 1  # a boss may come with the same rows
    for bad in [(1, "c", None, 1)], [(3, "a", None, 1)], [(3, "c", 9, 1)], [(3, "c", None, 0)], [(3, "too long", None, 1)], \
            [(None, "c", None, 1)], [(3, "c", None, 1), (3, "d", None, 1)], [(3, "c", None, 1), (4, "d", 9, 1)]:
        with pytest.raises(IntegrityError):
            add(*bad)
    assert store.state() == 1 and store.read().count() == 2
    add((3, "c", 2, 1))
    changes.insert(store, spark.range(4, 5), PEOPLE)
    assert sorted(rows(store.read(), "id", "pay"))[2:] == [(3, 1), (4, 1)]


def test_writes_through_views(spark):
    store = StoredTable.fresh(spark, "t")
    store.write(people(spark, None, 0, 0))
    view = TableView(store, PEOPLE, ["id", "name", "boss"], F.col("boss") == 0, checked=True)
    free = TableView(store, PEOPLE, ["id", "name", "boss"], F.col("boss") == 0)
    columns = table("v", "id bigint, name varchar(6), boss bigint")
    for row in (8, "x", 1), (8, "x", None), (2, "x", 0):  # outside, outside, key taken
        with pytest.raises(IntegrityError):
            view.insert(ingest.literal_rows(spark, columns, [row]))
    with pytest.raises(IntegrityError):
        view.update({"boss": F.lit(None)}, F.col("id") == 1)
    with pytest.raises(ValueError, match="no column"):
        view.update({"pay": F.lit(2)}, F.lit(True))
    assert store.state() == 1
    view.insert(ingest.literal_rows(spark, columns, [(8, "x", 0)]))
    view.update({"name": F.lit("z")}, F.col("id") < 2)
    assert sorted(rows(view.read())) == [(1, "z", 0), (2, "p2", 0), (8, "x", 0)] and ("p0",) in rows(store.read(), "name")
    free.update({"boss": F.lit(1)}, F.col("id") == 8)
    assert sorted(rows(view.read(), "id")) == [(1,), (2,)]
    state = store.state()
    for values in {"id": F.lit(2)}, {"id": F.lit(7)}, {"boss": F.lit(9)}, {"name": F.lit("too long")}:
        with pytest.raises(IntegrityError):
            free.update(values, F.lit(True))
    assert store.state() == state


def test_update_checks_what_it_touches(spark):
    """Two rows cannot move to one key, nor below zero; what an update leaves alone is not looked at."""
    spec = table("t", "id bigint, pay decimal(6,2)", primary_key=("id",), checks=(Check("pay", "pay >= 0"),))
    stored = StoredTable.fresh(spark, "t")
    stored.write(ingest.literal_rows(spark, spec, [(1, 5), (2, -3), (3, 1), (3, 1)]))
    key = F.col("id")
    for values, where in (
        ({"id": F.lit(7)}, key < 3), ({"id": F.lit(3)}, key == 1), ({"pay": F.lit(-1)}, key == 1), ({"id": F.lit(None)}, key == 1),
        ({"id": key + 1}, key == 1),
    ):
        with pytest.raises(IntegrityError):
            changes.update_stored(stored, values, where, spec)
    changes.update_stored(stored, {"pay": F.lit(9)}, key == 3, spec)  # its key repeats, but is not touched
    changes.update_stored(stored, {"id": key + 5}, key < 3, spec.__class__(**{**spec.__dict__, "checks": ()}))
    assert sorted(rows(stored.read())) == [(3, 9), (3, 9), (6, 5), (7, -3)]


def test_update_of_a_key_that_others_refer_to(spark):
    parent = table("p", "id bigint, code text", primary_key=("id",), unique=(("code",),))
    child = spark.createDataFrame([(1,), (None,)], "p long")
    fk = references("p", parent)
    stored = StoredTable.fresh(spark, "p")
    stored.write(ingest.literal_rows(spark, parent, [(1, "a"), (2, "b")]))
    key = F.col("id")
    update = lambda values, where: changes.update_stored(stored, values, where, parent, children=[("c", child, fk)])
    with pytest.raises(IntegrityError, match="still referred to"):
        update({"id": key + 10}, key == 1)
    update({"id": key + 10}, key == 2)
    update({"code": F.lit("z")}, key == 1)
    update({"id": F.when(key == 1, 12).otherwise(1)}, F.lit(True))  # keys may change places
    assert sorted(rows(stored.read())) == [(1, "b"), (12, "z")]


def test_top_key_orders_nulls_ties_and_signs(spark):
    data = [(1, -3, "1.50"), (1, -7, "1.50"), (1, 9, None), (2, 5, None), (2, 4, None), (3, 2**63 - 1, "-99.99"),
            (3, -(2**63), "-99.99"), (4, -(2**63), "0.01"), (4, 1, "0.00"), (5, 2**63 - 1, "9.00")]
    df = spark.createDataFrame(data, "g int, k long, s string").withColumn("s", F.col("s").cast("decimal(18,2)"))
    got = df.groupBy("g").agg(top_key(df, "s", "k").alias("k"))
    assert rows(got) == [(1, -7), (2, 4), (3, -(2**63)), (4, -(2**63)), (5, 2**63 - 1)]
