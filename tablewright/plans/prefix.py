"""Running totals, ranks, positions and dense keys that survive a hot group.

A window over a whole group puts that group into one task, which fails when one group
holds a third of all rows. Here every group is cut into blocks of consecutive keys.
A block holds at most ``2**BLOCK_BITS`` keys because keys are unique in their group, so
each window below sees a bounded number of rows whatever the group sizes are. Block
totals are added up the same way, one level higher. Everything is a plain aggregate,
window or equi-join; nothing goes through the driver and no partition ids are involved,
so a task that runs twice gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BITS = 22  # three levels of these leave 2**20 rows at the top of 64-bit keys

_BEFORE = (W.unboundedPreceding, -1)


def _sum_before(value: str, partition: list[str], order: str) -> Column:
    window = W.partitionBy(*partition).orderBy(order).rowsBetween(*_BEFORE)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def sum_before(
    df: DataFrame,
    group: list[str],
    key: str,
    weight: str,
    out: str,
    bits: int = BLOCK_BITS,
    key_bits: int = 64,
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over rows of the same group with a smaller key.

    ``key`` is a bigint of at most ``key_bits`` bits, unique in its group (a repeated one
    fails the job); group columns hold no NULL.
    """
    block, base = "__block", "__base"
    cut = df.withColumn(block, F.shiftright(key, bits))
    repeated = F.lag(key).over(W.partitionBy(*group, block).orderBy(key)) == F.col(key)
    before = F.when(repeated, F.raise_error(F.lit(f"{key} repeats a value"))).otherwise(_sum_before(weight, [*group, block], key))
    subtotals = cut.groupBy(*group, block).agg(F.sum(weight).alias(base))
    # Every block has its offset, so this could as well be an inner join; a left join
    # pushes no filter into one of two equal branches, and Spark computes the branch once.
    return (
        cut.withColumn(out, before)
        .join(_block_offsets(subtotals, group, block, base, bits, key_bits - bits), [*group, block], "left")
        .select(*df.columns, (F.col(out) + F.col(base)).cast("bigint").alias(out))
    )


def _block_offsets(
    blocks: DataFrame, group: list[str], block: str, base: str, bits: int, block_bits: int
) -> DataFrame:
    """Replace each block's subtotal by the sum of the subtotals before it."""
    if block_bits <= bits:  # few enough blocks in a group for one window
        return blocks.withColumn(base, _sum_before(base, group, block))
    super_block, super_base = "__super", "__super_base"
    cut = blocks.withColumn(super_block, F.shiftright(block, bits))
    supers = (
        cut.groupBy(*group, super_block)
        .agg(F.sum(base).alias(super_base))
        # 64-bit keys leave at most 2**(64 - 2 * bits) of these per group
        .withColumn(super_base, _sum_before(super_base, group, super_block))
    )
    return (
        cut.withColumn(base, _sum_before(base, [*group, super_block], block))
        .join(supers, [*group, super_block], "left")
        .select(*group, block, (F.col(base) + F.col(super_base)).alias(base))
    )


def dense_keys(df: DataFrame, order_by: str, out: str, start: int | Column = 1) -> DataFrame:
    """Number all rows from ``start`` without gaps, in the order of a unique bigint column.

    A NULL or a repeated value there fails the job.
    """
    weight = "__one"
    missing = F.raise_error(F.lit(f"{order_by} is NULL, which has no place in an order"))
    order = F.when(F.col(order_by).isNull(), missing).otherwise(F.col(order_by))
    counted = sum_before(df.withColumns({weight: F.lit(1), order_by: order}), [], order_by, weight, out)
    return counted.drop(weight).withColumn(out, F.col(out) + F.lit(start))


def later_in_group(df: DataFrame, group: list[str], key: str, out: str) -> DataFrame:
    """Add ``out``: how many rows of the same group have a larger key."""
    weight, reverse = "__one", "__reverse"
    marked = df.withColumns({weight: F.lit(1), reverse: -F.col(key)})
    return sum_before(marked, group, reverse, weight, out).drop(weight, reverse)


def rank_in_group(df: DataFrame, group: str, score: str, out: str) -> DataFrame:
    """Add ``out``: 1 + the number of rows in the same group with a higher score.

    Ties share a rank and leave gaps. A NULL group or score compares with nothing and
    ranks 1. ``score`` is a decimal of at most 18 digits. Equal scores are counted before
    the shuffle, and rows without a score skip the join, so neither a hot group nor a hot
    score gathers rows.
    """
    descending, ties = "__descending", "__ties"
    type_ = df.schema[score].dataType
    if not isinstance(type_, T.DecimalType) or type_.precision > 18:
        raise ValueError(f"{score} must be a decimal of at most 18 digits")
    # digits and sign
    key_bits = (10**type_.precision).bit_length() + 1
    scores = (
        df.filter(F.col(group).isNotNull() & F.col(score).isNotNull())
        .groupBy(group, score)
        .agg(F.count("*").alias(ties))
        .withColumn(descending, (-F.col(score) * 10**type_.scale).cast("bigint"))
    )
    ranks = sum_before(scores, [group], descending, ties, out, key_bits=key_bits).select(
        group, score, (F.col(out) + 1).alias(out)
    )
    scored = F.col(group).isNotNull() & F.col(score).isNotNull()
    ranked = df.filter(scored).join(ranks, [group, score]).select(*df.columns, F.col(out).cast("bigint").alias(out))
    return ranked.unionByName(df.filter(~scored).withColumn(out, F.lit(1).cast("bigint")))
