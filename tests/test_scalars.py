import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import duckdb
from pyspark.sql import functions as F

from tablewright.functions.scalars import average, format_text, ratio, round_to_int, rounded_quotient, whole_years


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_format_and_round(spark):
    assert one(spark, format_text("%s/%s", F.lit(1), F.lit(None))) == "1/"
    assert [one(spark, round_to_int(F.lit(Decimal(x)))) for x in ("2.5", "-2.5", "2.4")] == [3, -3, 2]


def test_ratio_rounds_half_away_from_zero(spark):
    cases = [("0.01", 2), ("-0.01", 2), ("100.00", 3), ("1.00", 8), ("9" * 34 + ".99", 10**18), ("5.00", -3), ("1.00", 0)]
    df = spark.createDataFrame([(Decimal(a), b) for a, b in cases], "a decimal(38,2), b long")
    got = [r[0] for r in df.select(ratio("a", "b")).collect()]
    exact = lambda a, b: (Decimal(a) / b).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == [exact(a, b) if b else None for a, b in cases]


def test_rounded_quotient(spark):
    assert [one(spark, rounded_quotient(F.lit(n), F.lit(2))) for n in (1, -1, 3, 4)] == [1, -1, 2, 2]


def test_average_is_exact(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),), (None,)], "x decimal(10,2)")
    assert df.agg(average("x")).first()[0] == Decimal("0.02")
    assert df.filter("x IS NULL").agg(average("x")).first()[0] is None


def test_whole_years_equals_age(spark):
    start = dt.date(2015, 2, 20)
    days = [(start + dt.timedelta(d),) for d in range(0, 3000, 7)]
    df = spark.createDataFrame(days, "d date")
    for today in ("2020-02-29", "2021-02-28", "2016-12-31"):
        got = [r[0] for r in df.select(whole_years(F.lit(today).cast("date"), "d")).collect()]
        want = [
            duckdb.execute("SELECT extract(year FROM age(?::DATE, ?::DATE))", [today, d]).fetchone()[0]
            for (d,) in days
        ]
        assert got == want
    assert one(spark, whole_years(F.lit(None).cast("date"), F.current_date())) is None


def test_average_rounds_once(spark):
    rare = spark.range(2_000_001).select(F.when(F.col("id") == 0, F.lit(Decimal("10000.00"))).otherwise(0).cast("decimal(38,2)").alias("x"))
    assert rare.agg(average("x")).first()[0] == Decimal("0.00")
    assert spark.createDataFrame([(1,), (2,)], "x int").agg(average("x")).first()[0] == Decimal("1.50")
