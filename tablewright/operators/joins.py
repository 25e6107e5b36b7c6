"""Join forms whose plan stays sound when a key is hot or a side is large.

Spark picks broadcast, sort-merge or hash joins from the sizes it knows; nothing is
hinted here. What these functions add:

* an outer join that preserves a dimension is split into a join that preserves the
  large side plus an anti join, because Spark cannot broadcast a preserved side and
  cannot split a hot key on the side it does not preserve;
* the inner side of a semi or anti join is reduced to distinct keys first, grouped so that
  the join still shuffles both sides itself, which is what lets AQE split a hot key;
* NULL keys, which match nothing, are spread over many tasks instead of hashing to one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(on: str | list[str] | dict[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, dict) else {c: c for c in on}


def per_join_key(df: DataFrame, columns: list[str], *aggregates: Column) -> DataFrame:
    """One row for each key value, for a join on the key whose other side may have a hot one.

    AQE splits a join only where both sides come straight from a shuffle. An aggregate by the
    join key would serve the join as it is partitioned, and stand in between. Grouped by the key
    and a hash of it, its rows are shuffled once more, one for each key, and the join can be split.
    """
    extra = "__hash"
    keyed = df.withColumn(extra, F.xxhash64(*columns)).groupBy(*columns, extra)
    return keyed.agg(*(aggregates or [F.lit(True).alias("__one")])).drop(extra, "__one")


def distinct_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct non-NULL key values; combined before the shuffle, so no key is hot."""
    return per_join_key(df.select(*columns).dropna(subset=columns), columns)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns of the same name, each appearing once."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("no common column; product_totals() sums over the product")
    return left.join(right, common, how)


def _key_test(
    right: DataFrame, on: str | list[str] | dict[str, str], unique: bool
) -> tuple[DataFrame, Column]:
    """The distinct keys of ``right`` under fresh names, and the condition that matches them."""
    pairs = _pairs(on)
    names = {r: f"__key{i}" for i, r in enumerate(pairs.values())}
    keys = right.select(*[F.col(r).alias(n) for r, n in names.items()])
    keys = keys if unique else distinct_keys(keys, list(names.values()))
    return keys, reduce(lambda a, b: a & b, [F.col(l) == F.col(names[r]) for l, r in pairs.items()])


def matched(
    left: DataFrame, right: DataFrame, on: str | list[str] | dict[str, str], unique: bool = False
) -> DataFrame:
    """Rows of ``left`` with at least one match (EXISTS, IN); none is repeated.

    ``on`` names common columns or maps left columns to right ones. ``unique`` says that no key repeats in
    ``right``: its rows are joined as they lie, so tables bucketed by the key are not shuffled.
    """
    return left.join(*_key_test(right, on, unique), "left_semi")


def unmatched(
    left: DataFrame, right: DataFrame, on: str | list[str] | dict[str, str], unique: bool = False
) -> DataFrame:
    """Rows of ``left`` without a match, those with a NULL key among them."""
    return left.join(*_key_test(right, on, unique), "left_anti")


def left_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread: str) -> DataFrame:
    """Left outer join between two large sides with many NULLs in ``left_key``.

    A row with a NULL key joins nothing, so it may go to any task: ``spread`` is a column
    of ``left`` whose whole hash is the salt.
    """
    salt, right_salt = "__salt", "__right_salt"
    salted = left.withColumn(
        salt,
        F.when(F.col(left_key).isNull(), F.xxhash64(spread)).otherwise(
            F.lit(0).cast("bigint")
        ),
    )
    # Rows with a key have salt 0 on both sides. The right one is computed from the key:
    # a literal 0 would be folded out of the join keys, and the salt with it.
    zero = F.xxhash64(right_key).bitwiseAND(F.lit(0).cast("bigint"))
    on = (F.col(left_key) == F.col(right_key)) & (F.col(salt) == F.col(right_salt))
    return salted.join(right.withColumn(right_salt, zero), on, "left").drop(salt, right_salt)


def right_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str, right_is_dimension: bool) -> DataFrame:
    """All rows of ``right``; column names must be distinct across the sides.

    ``right_is_dimension`` says that it is much the smaller side. The join is split then,
    which reads ``left`` twice; otherwise each side is read and sorted once.
    """
    if not right_is_dimension:
        return left.join(right, F.col(left_key) == F.col(right_key), "right")
    both = left.join(right, F.col(left_key) == F.col(right_key))
    alone = unmatched(right, left, {right_key: left_key})
    return both.unionByName(alone, allowMissingColumns=True)


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str, right_is_dimension: bool) -> DataFrame:
    """All rows of both sides; see ``right_outer``."""
    if not right_is_dimension:
        return left.join(right, F.col(left_key) == F.col(right_key), "full")
    kept = left.join(right, F.col(left_key) == F.col(right_key), "left")
    alone = unmatched(right, left, {right_key: left_key})
    return kept.unionByName(alone, allowMissingColumns=True)


def unmatched_either(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_label: str, right_label: str, label: str
) -> DataFrame:
    """A full outer join's unmatched rows of both sides, labelled by side."""
    left_only = unmatched(left, right, {left_key: right_key}).withColumn(label, F.lit(left_label))
    right_only = unmatched(right, left, {right_key: left_key}).withColumn(label, F.lit(right_label))
    return left_only.unionByName(right_only, allowMissingColumns=True)


def product_totals(members: DataFrame, df: DataFrame, value: str) -> DataFrame:
    """For each row of ``members``, its pairs in the product with ``df`` and their sum of ``value``.

    Every member meets every row of ``df``, so one aggregate of ``df`` serves them all.
    """
    totals = df.agg(F.count("*").cast("decimal(38,0)").alias("pairs"), F.sum(F.col(value).cast("decimal(38,2)")).alias("total"))
    both = totals.select(F.struct("pairs", "total")).scalar()
    return members.withColumn("__both", both).select(*members.columns, "__both.pairs", "__both.total").filter("pairs > 0")


def pair_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """The size of a product of two tables, without building it."""
    counts = left.agg(F.count("*").alias("l")).select(
        F.col("l").cast("decimal(19,0)"),
        right.agg(F.count("*").cast("decimal(19,0)")).scalar().alias("r"),
    )
    return counts.select((F.col("l") * F.col("r")).cast("decimal(38,0)").alias("pairs"))
