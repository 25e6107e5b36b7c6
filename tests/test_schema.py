"""Declared tables and their changes."""

import pytest
from pyspark.sql import types as T

from tablewright.sources.ingest import append, literal_rows
from tablewright.sources.spec import (
    AddColumn,
    Computed,
    DropColumn,
    Field,
    SetDefault,
    SetType,
    alter,
    spark_type,
    table,
)
from tests.fixtures import rows

# --- fixed values: declared columns of the university tables and their changes ----------
STUDENTS = table(
    "students",
    "student_id serial, first_name varchar(50)!, last_name varchar(50)!, email varchar(100), phone char(15),"
    "date_of_birth date, enrollment_date date, gpa numeric(4,2), is_active boolean = true, graduation_year smallint",
    primary_key=("student_id",),
    unique=(("email",),),
)
PROFESSORS = table(
    "professors",
    "professor_id serial, first_name varchar(50)!, last_name varchar(50)!, email varchar(100),"
    "office_number varchar(20), hire_date date, salary numeric(12,2), is_tenured boolean = false,"
    "years_experience integer",
)
COURSES = table(
    "courses",
    "course_id serial, course_code char(8)!, course_title varchar(100)!, description text, credits smallint,"
    "max_enrollment integer, course_fee numeric(10,2), is_online boolean = false, created_at timestamp = current_timestamp()",
)
SCHEDULE = table(
    "class_schedule",
    "schedule_id serial, course_id integer, professor_id integer, classroom varchar(20), class_date date,"
    "start_time time, end_time time, duration interval",
)
RECORDS = table(
    "student_records",
    "record_id serial, student_id integer, course_id integer, semester varchar(20), year integer, grade char(2),"
    "attendance_percentage numeric(5,1), submission_timestamp timestamptz = now(), last_updated timestamptz = now()",
)
CHANGES = {
    STUDENTS: [
        AddColumn(Field("middle_name", "varchar(30)")),
        AddColumn(Field("students_status", "varchar(20)", default="ACTIVE")),
        SetType("phone", "varchar(20)"),
        SetDefault("gpa", "0.00"),
        AddColumn(Field("advisor_id", "integer")),
    ],
    PROFESSORS: [
        AddColumn(Field("department_code", "char(5)")),
        AddColumn(Field("research_area", "text")),
        SetType("years_experience", "smallint"),
        SetDefault("is_tenured", False),
        AddColumn(Field("last_promotion_date", "date")),
        AddColumn(Field("department_id", "integer")),
    ],
    COURSES: [
        AddColumn(Field("prerequisite_course_id", "integer")),
        AddColumn(Field("difficulty_level", "smallint")),
        SetType("course_code", "varchar(10)"),
        SetDefault("credits", 3),
        AddColumn(Field("lab_required", "boolean", default=False)),
        AddColumn(Field("department_id", "integer")),
    ],
    SCHEDULE: [
        AddColumn(Field("room_capacity", "integer")),
        AddColumn(Field("session_type", "varchar(15)")),
        AddColumn(Field("equipment_needed", "text")),
        DropColumn("duration"),
        SetType("classroom", "varchar(30)"),
    ],
    RECORDS: [
        AddColumn(Field("extra_credit_points", "decimal(4,1)", default="0.0")),
        AddColumn(Field("final_exam_date", "date")),
        SetType("grade", "varchar(5)"),
        DropColumn("last_updated"),
    ],
}


@pytest.mark.parametrize("spec", CHANGES, ids=lambda s: s.name)
def test_university_changes(spark, spec):
    df, changed = alter(spec.empty(spark), spec, *CHANGES[spec])
    assert df.columns == changed.columns
    assert [f.dataType for f in df.schema] == [f.dataType for f in changed.schema]
    added = {c.field.name for c in CHANGES[spec] if isinstance(c, AddColumn)}
    dropped = {c.name for c in CHANGES[spec] if isinstance(c, DropColumn)}
    assert set(changed.columns) == (set(spec.columns) | added) - dropped


def test_changed_students(spark):
    df = literal_rows(
        spark, STUDENTS, [(1, "Ann", "Lee", "a@x", "555            ", "2004-05-06", "2022-09-01", "3.50", True, 2026)]
    )
    df, spec = alter(df, STUDENTS, *CHANGES[STUDENTS])
    new = literal_rows(spark, spec, [(2, "Bo", "Ray")], ["student_id", "first_name", "last_name"])
    got = {r.student_id: r for r in df.unionByName(new).collect()}
    assert (got[1].phone, got[1].students_status, got[1].middle_name) == ("555", "ACTIVE", None)
    assert (str(got[2].gpa), got[2].is_active, got[2].students_status) == ("0.00", True, "ACTIVE")


def test_added_moment_is_fixed(spark):
    spec = table("t", "id bigint")
    df, changed = alter(spark.range(3), spec, AddColumn(Field("at", "timestamp", default=Computed("now()"))))
    first = {r.at for r in df.collect()}
    assert len(first) == 1 and {r.at for r in df.collect()} == first
    later = append(df, spark.range(9, 10), changed).filter("id = 9").first().at
    assert later > first.pop()


def test_types():
    assert spark_type("NUMERIC") == "decimal(38,18)" and spark_type("numeric(8)") == "decimal(8,0)"
    assert spark_type("TIMESTAMP") == "timestamp_ntz" and spark_type("varchar(9)") == "string"
    with pytest.raises(ValueError):
        spark_type("geometry")
    assert isinstance(SCHEDULE.schema["duration"].dataType, T.DayTimeIntervalType)


def test_narrowing_refuses_large_values(spark):
    df, _ = alter(spark.createDataFrame([(40000,)], "n int"), table("t", "n int"), SetType("n", "smallint"))
    with pytest.raises(Exception, match="CAST_OVERFLOW|out of range"):
        df.collect()


def test_all_or_nothing(spark):
    df, spec = spark.range(1), table("t", "id bigint")
    for bad in (DropColumn("x"), SetType("x", "int"), SetDefault("x", 1), AddColumn(Field("id", "int"))):
        with pytest.raises(ValueError):
            alter(df, spec, AddColumn(Field("n", "int")), bad)


def test_conform_rounds_into_integers(spark):
    spec = table("t", "n int, c char(4)")
    df = spark.createDataFrame([(2.5, "ab  ")], "n double, c string")
    assert rows(spec.conform(df)) == [(3, "ab")]
    big = spark.createDataFrame([(2**53 + 1,)], "n long")
    assert rows(table("t", "n bigint").conform(big)) == [(2**53 + 1,)]
    assert rows(append(spec.empty(spark), df.drop("c"), spec)) == [(3, None)]
