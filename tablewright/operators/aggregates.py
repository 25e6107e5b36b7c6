"""Grouped results over parent/child joins.

Children are always summed up per key before the join: the partial aggregate shrinks a
hot key to one row per task, and the join then moves one row per key.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalars import average, total


def per_key(child: DataFrame, key: str, **aggs: Column) -> DataFrame:
    """One row per non-NULL key with the given aggregates."""
    return (
        child.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[agg.alias(name) for name, agg in aggs.items()])
    )


def with_children(parent: DataFrame, child: DataFrame, key: str, empty: dict[str, Any], **aggs: Column) -> DataFrame:
    """All parents with aggregates over their children; ``empty`` fills childless parents."""
    summed = per_key(child, key, **aggs)
    filled = [
        F.coalesce(F.col(n), F.lit(empty[n]).cast(summed.schema[n].dataType)).alias(n) if n in empty else n
        for n in aggs
    ]
    return parent.join(summed, key, "left").select(*parent.columns, *filled)


def fan_out_totals(
    parent: DataFrame, key: str, first: DataFrame, first_value: str, second: DataFrame, second_value: str
) -> DataFrame:
    """Counts and sums over ``parent`` left-joined to two child tables at once.

    Joining both children repeats each row of one child for each row of the other, and
    the counts and sums are over those repeated rows. The same numbers follow from each
    child's own count and sum, so no repeated row is ever built. ``*_distinct`` columns
    hold the plain totals beside them.
    """
    one = per_key(first, key, n1=F.count("*"), s1=total(first_value), m1=average(first_value))
    two = per_key(second, key, n2=F.count("*"), s2=total(second_value))
    joined = parent.join(one, key, "left").join(two, key, "left")
    zero = "CAST(0 AS DECIMAL(38,2))"
    filled = joined.selectExpr(
        *parent.columns,
        "coalesce(n1, 0) AS n1",
        "coalesce(n2, 0) AS n2",
        f"coalesce(s1, {zero}) AS s1",
        f"coalesce(s2, {zero}) AS s2",
        "m1",
        # how often a row of the other child is repeated
        "greatest(coalesce(n1, 0), 1) AS times1",
        "greatest(coalesce(n2, 0), 1) AS times2",
    )
    return filled.selectExpr(
        *parent.columns,
        "CAST(CAST(n1 AS DECIMAL(19,0)) * CAST(times2 AS DECIMAL(19,0)) AS DECIMAL(38,0)) AS first_count",
        "CAST(s1 * CAST(times2 AS DECIMAL(19,0)) AS DECIMAL(38,2)) AS first_sum",
        "CAST(CAST(n2 AS DECIMAL(19,0)) * CAST(times1 AS DECIMAL(19,0)) AS DECIMAL(38,0)) AS second_count",
        "CAST(s2 * CAST(times1 AS DECIMAL(19,0)) AS DECIMAL(38,2)) AS second_sum",
        "n1 AS first_count_distinct",
        "s1 AS first_sum_distinct",
        "n2 AS second_count_distinct",
        "s2 AS second_sum_distinct",
        # an average is not changed by repetition: sum and count grow alike
        "m1 AS first_average",
        "CAST(CAST(times1 AS DECIMAL(19,0)) * CAST(times2 AS DECIMAL(19,0)) AS DECIMAL(38,0)) AS joined_rows",
    )
