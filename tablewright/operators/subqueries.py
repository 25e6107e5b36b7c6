"""Subquery predicates. EXISTS and IN are ``joins.matched``, NOT EXISTS ``joins.unmatched``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import per_join_key


def above_any(df: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """``column > ANY (others)``: above the smallest; an empty or all-NULL set keeps none."""
    smallest = others.agg(F.min(other)).scalar()
    return df.filter(F.col(column) > smallest)


def not_in(df: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """``column NOT IN (others)`` with SQL's NULL rules.

    An empty set keeps all rows; a NULL in the set keeps none; a NULL ``column`` is
    kept only by an empty set. The set is never broadcast as a whole, and worked out once:
    its two facts come from the same distinct values that the anti join uses. NULL is one of
    them; comparing it as a value keeps the two plans equal, and the rows it matches go anyway.
    """
    value = "__value"
    distinct = others.select(F.col(other).alias(value)).distinct()
    facts = distinct.agg(F.struct(F.count("*").alias("n"), F.count(value).alias("known"))).scalar()
    kept = df.join(distinct, F.col(column).eqNullSafe(F.col(value)), "left_anti")
    none = facts["n"] == 0
    return kept.filter(none | ((facts["n"] == facts["known"]) & F.col(column).isNotNull()))


def single_value(
    df: DataFrame, on: str, lookup: DataFrame, key: str, value: str, out: str, found: str | None = None
) -> DataFrame:
    """Add ``out``: the one ``value`` whose ``key`` equals ``on``, or NULL.

    A matched key with more than one row fails the job, as a scalar subquery does. ``found``
    names a column that tells a matched NULL from no match. Rows of a hot key in ``df`` are split.
    """
    count = "__count"
    known = lookup.filter(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(value).alias(out))
    values = per_join_key(known, ["__key"], F.count("*").alias(count), F.first(out).alias(out))
    checked: Column = F.when(
        F.col(count) > 1, F.raise_error(F.concat(F.lit("more than one row for "), F.col(on).cast("string")))
    ).otherwise(F.col(out))
    joined = df.join(values, F.col(on) == F.col("__key"), "left").withColumn(out, checked)
    if found:
        joined = joined.withColumn(found, F.col(count).isNotNull())
    return joined.drop("__key", count)
