"""Views, versioned tables and materialized views over the small company."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright import session
from tablewright.operators import changes
from tablewright.operators.quality import IntegrityError
from tablewright.plans.views import MaterializedView, create_view, drop_view, rename_view
from tablewright.sources.ingest import append, literal_rows
from tablewright.sources.stored import ConcurrentChange, StoredTable, snapshot
from tablewright.workloads import viewing
from tablewright.workloads.aggregation import dashboard, dept_summary
from tests.fixtures import COMPANY_EMP, company, rows


@pytest.fixture(scope="module")
def t(spark):
    return company(spark)


COLUMNS = ["emp_id", "emp_name", "dept_id", "salary"]


def hire(df, *row):
    return append(df, literal_rows(df.sparkSession, COMPANY_EMP, [row], COLUMNS).select(COLUMNS), COMPANY_EMP)


def test_views(t):
    assert viewing.employee_details(t).count() == 4
    assert [r.dept_name for r in viewing.dept_statistics_view(t).collect()] == ["IT", "HR", "Finance", "Marketing"]
    assert dict(rows(viewing.project_overview_view(t), "project_name", "team_size")) == {
        "Website Redesign": 2, "Employee Training": 1, "Budget Analysis": 1, "Cloud Migration": 2,
    }
    for plan in (viewing.high_earners, viewing.rename):
        assert rows(plan(t)) == [("Jane Doe", 60000.0, "HR"), ("Sarah Williams", 65000.0, "Finance")]
    assert dict(rows(viewing.replace(t), "emp_name", "salary_grade")) == {
        "John Smith": "Standard", "Mike Johnson": "Medium", "Jane Doe": "Medium", "Sarah Williams": "High",
    }
    assert rows(viewing.create_drop(t), "emp_name") == [("Tom Brown",)]
    assert rows(viewing.high_budget(t), "project_name", "approval_status") == [
        ("Cloud Migration", "Management Approval Needed"), ("Website Redesign", "Standard Process"),
    ]


def test_view_names(spark, t):
    create_view(t.emp, "some_view")
    with pytest.raises(AnalysisException):
        create_view(t.emp, "some_view")
    assert rename_view(spark, "some_view", "other_view").count() == 5
    assert drop_view(spark, "other_view") and not drop_view(spark, "other_view")
    with pytest.raises(AnalysisException):
        spark.table("some_view")


def after_writes(t):
    emp = changes.update(t.emp, {"salary": F.lit(52000)}, F.col("emp_name") == "John Smith")
    emp = hire(emp, 6, "Alice Johnson", 102, 58000)
    return hire(emp, 8, "Charlie Brown", 101, 54000)


def test_dashboard_after_writes(t):
    got = {r[0]: tuple(map(float, r[2:])) for r in dashboard(t.dept, after_writes(t), t.proj).collect()}
    assert got == {
        "IT": (6, 53666.67, 6, 750000, 125000), "HR": (2, 59000, 2, 100000, 50000),
        "Finance": (1, 65000, 1, 75000, 75000), "Marketing": (0, 0, 0, 0, 0),
    }


def test_materialized_view_is_stale_until_refreshed(spark, t, tmp_path):
    base = StoredTable.fresh(spark, "emp")
    emp = changes.update(t.emp, {"salary": F.lit(52000)}, F.col("emp_name") == "John Smith")
    base.write(hire(emp, 6, "Alice Johnson", 102, 58000))
    mv = MaterializedView(StoredTable.fresh(spark, "mv"), lambda: dept_summary(t.dept, base.read(), t.proj), key=["dept_id"])
    with pytest.raises(LookupError, match="not been populated"):
        mv.read()
    mv.refresh()
    assert rows(mv.read(), "dept_name", "total_employees", "total_salaries", "total_projects", "total_budget") == [
        ("Finance", 1, 65000.0, 1, 75000.0), ("HR", 2, 118000.0, 2, 100000.0),
        ("IT", 4, 214000.0, 4, 500000.0), ("Marketing", 0, 0.0, 0, 0.0),
    ]
    base.append(literal_rows(spark, COMPANY_EMP, [(8, "Charlie Brown", 101, 54000)], COLUMNS))
    it = F.col("dept_name") == "IT"
    reader = mv.read()
    assert rows(reader.filter(it), "total_employees", "total_salaries") == [(4, 214000.0)]
    mv.refresh()
    assert rows(reader.filter(it), "total_employees") == [(4,)]
    assert rows(mv.read().filter(it), "total_employees", "total_salaries", "total_budget") == [(6, 322000.0, 750000.0)]
    assert rows(mv.read(1).filter(it), "total_employees") == [(4,)]


def test_refresh_with_repeated_key_keeps_the_old_result(spark, tmp_path):
    plans = [spark.range(2), spark.range(2).union(spark.range(1))]
    mv = MaterializedView(StoredTable.fresh(spark, "mv"), lambda: plans[0], key=["id"])
    mv.refresh()
    plans.reverse()
    with pytest.raises(IntegrityError):
        mv.refresh()
    assert rows(mv.read()) == [(0,), (1,)]


def test_states_and_snapshots(spark):
    table = StoredTable.fresh(spark, "t")
    assert table.state() is None
    table.write(spark.range(3))
    taken = snapshot(table.read(), "s")
    pinned = table.read()
    table.write(table.read().filter("id > 0"))
    table.append(spark.range(7, 8))
    assert sorted(rows(table.read())) == [(1,), (2,), (7,)]
    assert sorted(rows(pinned)) == sorted(rows(taken)) == sorted(rows(table.read(1))) == [(0,), (1,), (2,)]
    with pytest.raises(LookupError, match="state 9"):
        table.read(9)


def test_shared_folder_comes_from_the_session(spark, tmp_path, monkeypatch):
    own = session.shared_folder(spark)
    assert session.shared_folder(spark) == own

    class Conf:
        def get(self, key, default):
            return {"spark.checkpoint.dir": str(tmp_path)}[key]

    class Named:
        conf = Conf()

    assert session.shared_folder(Named()) == str(tmp_path)

    class Cluster:
        conf = type("C", (), {"get": lambda self, key, default: default})()
        sparkContext = type("S", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError):
        session.shared_folder(Cluster())


def test_two_writers_of_one_state(spark):
    one = StoredTable.fresh(spark, "t")
    two = StoredTable(spark, one.name)
    one.write(spark.range(2))
    seen = two.state()
    staged = two.stage(spark.range(9))
    assert one.state() == seen and sorted(rows(one.read())) == [(0,), (1,)]  # what is staged is not a state
    one.write(spark.range(5))
    with pytest.raises(ConcurrentChange, match="state 2, not 1"):
        two.publish(staged, after=seen)
    with pytest.raises(ConcurrentChange, match="state 2, not 1"):
        two.write(spark.range(9), after=seen)
    assert one.read().count() == 5
    assert two.publish(staged) == 3 and one.read().count() == 9


def test_append_keeps_names_and_types(spark):
    table = StoredTable.fresh(spark, "t")
    table.write(spark.range(1))
    for wrong in (spark.range(1).withColumn("x", F.lit(1)), spark.range(1).select(F.col("id").cast("int"))):
        with pytest.raises(ValueError, match="holds"):
            table.append(wrong)
    assert table.state() == 1 and table.read().count() == 1


def test_vacuum_drops_older_states(spark):
    table = StoredTable.fresh(spark, "t")
    for n in (1, 2, 4):
        table.write(spark.range(n))
    table.vacuum(keep=2)
    assert table.states() == [2, 3] and table.read(2).count() == 2 and table.read().count() == 4
    with pytest.raises(LookupError):
        table.read(1)


def files(table):
    return {f.rsplit("/", 2)[1] + "/" + f.rsplit("/", 1)[1] for f in table.read().inputFiles()}


def test_a_new_column_rewrites_no_file(spark):
    table = StoredTable.fresh(spark, "t")
    table.write(spark.range(3))
    old = files(table)
    table.add_column("kind", "STRING", "'A'")
    table.add_column("size", "DECIMAL(4,1)", "0.0")
    table.add_column("note", "STRING")
    assert files(table) == old and table.read().filter("kind = 'A' AND size = 0 AND note IS NULL").count() == 3
    table.set_default("kind", "'B'")
    table.append(spark.range(5, 6))
    table.set_default("kind", None)
    table.append(spark.range(6, 7))
    assert {r[0]: r[1] for r in rows(table.read().select("id", "kind"))} == {0: "A", 1: "A", 2: "A", 5: "B", 6: None}
    assert old < files(table)


def test_a_delete_leaves_other_partitions_alone(spark):
    table = StoredTable.fresh(spark, "t")
    part = F.when(F.col("id") % 4 < 3, F.concat(F.lit("it's "), F.col("id") % 4))
    table.write(spark.range(40).withColumn("part", part), partition_by=("part",))
    before = files(table)
    where = ((F.col("id") % 4 == 1) & (F.col("id") < 20)) | F.col("part").isNull()
    assert table.delete_in_partitions(where, ("part",)) == 2
    assert sorted(r[0] for r in rows(table.read().select("id"))) == [i for i in range(40) if not (i % 4 == 1 and i < 20 or i % 4 == 3)]
    kept = {f for f in before if f.split("/")[0].endswith((" 0", " 2", "%200", "%202"))}
    assert kept and kept <= files(table) and not (before - kept) & files(table)
    assert table.delete_in_partitions(F.col("id") < 0, ("part",)) == 0
    assert table.delete_in_partitions(F.lit(True), ("part",)) == 3 and table.read().count() == 0
