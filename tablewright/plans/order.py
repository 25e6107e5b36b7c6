"""Positions, running totals and ranks in the order of any sortable columns.

``plans.prefix`` cuts groups by the value of a whole number. Text, timestamps, composite keys and wide
decimals have no such cut, so here Spark's range partitioning finds the splitters: rows are dealt by
group and order, sorted in their partitions and written with their place. A window then sees
the rows of one group in one partition, whose size the partitioning bounds, and the partitions' totals
are added up per group, a row for each partition. A hot group lies in many partitions. The places are
written once, so a task that runs again finds the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.sources.stored import snapshot

_PLACE, _PART, _BASE = "__place", "__part", "__base"


def sum_before_in_order(df: DataFrame, by: list[str], order: list[Column], weight: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the same group that come before.

    Rows that ``order`` does not tell apart come one after the other. Group columns hold no NULL.
    """
    ordered = [*(F.col(c) for c in by), *order]
    placed = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    placed = snapshot(placed.withColumn(_PLACE, F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn(_PART, F.shiftright(_PLACE, 33))
    earlier = (W.unboundedPreceding, -1)
    within = F.sum(weight).over(W.partitionBy(*by, _PART).orderBy(_PLACE).rowsBetween(*earlier))
    totals = placed.groupBy(*by, _PART).agg(F.sum(weight).alias(_BASE))
    base = F.coalesce(F.sum(_BASE).over(W.partitionBy(*by).orderBy(_PART).rowsBetween(*earlier)), F.lit(0))
    totals = totals.select(*by, _PART, base.alias(_BASE))
    summed = placed.withColumn(out, F.coalesce(within, F.lit(0))).join(totals, [*by, _PART])
    return summed.select(*df.columns, (F.col(out) + F.col(_BASE)).cast("bigint").alias(out))


def number_rows(df: DataFrame, order: list[Column], out: str, start: int | Column = 1) -> DataFrame:
    """Number all rows from ``start`` without gaps, in the order of any columns; equal rows in any order."""
    one = "__one"
    counted = sum_before_in_order(df.withColumn(one, F.lit(1)), [], order, one, out)
    return counted.drop(one).withColumn(out, F.col(out) + F.lit(start))


def rank_by(df: DataFrame, group: str, score: str, out: str) -> DataFrame:
    """Add ``out``: 1 + the number of rows in the same group with a higher score of any sortable type.

    Ties share a rank and leave gaps; a NULL group or score ranks 1. Equal scores are one row before
    they are ordered.
    """
    ties, scored = "__ties", F.col(group).isNotNull() & F.col(score).isNotNull()
    scores = df.filter(scored).groupBy(group, score).agg(F.count("*").alias(ties))
    ranks = snapshot(sum_before_in_order(scores, [group], [F.col(score).desc()], ties, out).select(group, score, out), "ranks")
    ranked = df.filter(scored).join(ranks, [group, score]).select(*df.columns, (F.col(out) + 1).alias(out))
    return ranked.unionByName(df.filter(~scored).withColumn(out, F.lit(1).cast("bigint")))
