"""Registration of queries with the SQL that states their result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.sources.tables import Tables, with_frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

Plan = Callable[[Tables], DataFrame]


def query(key: str, sql: str | None = None, frames: str = "") -> Callable[[Plan], Plan]:
    """Register ``plan(tables)`` as ``key``; ``frames`` names the frames that ``sql`` reads."""

    def register(plan: Plan) -> Plan:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: plan(Tables(spark, sf_dir))
        if sql is not None:
            SQL[key] = with_frames(frames, sql)
        return plan

    return register


def sql_avg(x: str) -> str:
    """ROUND(AVG(x), 2) for a non-negative decimal, half up, in whole cents.

    DuckDB averages decimals as doubles, which can round a tie the other way.
    """
    return (
        f"CAST(CAST((2 * SUM(CAST({x} * 100 AS HUGEINT)) + COUNT({x})) // (2 * COUNT({x}))"
        f" AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2))"
    )


def sql_ratio(total: str, count: str) -> str:
    """ROUND(total / count, 2) for a non-negative decimal total, in whole cents."""
    return (
        f"CAST(CAST((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * {count})"
        f" AS DECIMAL(30,0)) * 0.01 AS DECIMAL(38,2))"
    )
