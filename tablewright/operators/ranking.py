"""Top rows per group. Ranks over whole groups are in ``plans.prefix``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LARGEST = 2**63 - 1
_KEYS = "20000000000000000000"  # more than there are bigints
_BELOW_ALL = -(10**18)  # where a NULL score ranks


def top_key(df: DataFrame, score: str, key: str) -> Column:
    """Aggregate: the bigint ``key`` of the row with the highest score, NULL scores last.

    Equal scores go to the smallest key. ``score`` is a decimal of at most 18 digits. Score and
    key make up one decimal, which a hash aggregate updates in place: one running maximum per
    group and task, so a group's size does not matter and nothing is sorted.
    """
    type_ = df.schema[score].dataType
    if not isinstance(type_, T.DecimalType) or type_.precision > 18:
        raise ValueError(f"{score} must be a decimal of at most 18 digits")
    whole = (F.col(score) * F.lit(10**type_.scale)).cast("decimal(18,0)")
    level = F.coalesce(whole.cast("decimal(19,0)"), F.lit(_BELOW_ALL).cast("decimal(19,0)"))
    keys = F.lit(_KEYS).cast("decimal(20,0)")
    largest = F.lit(_LARGEST).cast("decimal(20,0)")
    top = F.max(level * keys + (largest - F.col(key).cast("decimal(20,0)")))
    return (largest - F.pmod(top, keys)).cast("bigint")


def with_rows(tops: DataFrame, top: str, df: DataFrame, key: str, **columns: str) -> DataFrame:
    """Replace ``top`` by columns of the row of ``df`` with that ``key``, which is unique there."""
    rows = df.select(F.col(key).alias(top), *[F.col(c).alias(name) for name, c in columns.items()])
    return tops.join(rows, top).drop(top)
