"""Hierarchies of any depth by pointer doubling.

Each row points to its parent. A round lets every row take over what its pointer's row knows, and
that row's pointer, so what a row knows doubles with every round and a chain of n levels takes
log2(n) rounds, each one join. Rounds are written, which cuts the lineage, and the plan of a round
does not grow. The pointers' rows are unique and not grouped, so AQE can split the rows that
point to one parent; rows that have arrived leave the rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.sources.stored import StoredTable


def levels(df: DataFrame, key: str, parent: str) -> DataFrame:
    """key, top and depth: of each row, the last ancestor and the number of rows above it.

    ``key`` is unique and not NULL. A parent that is NULL or not a row ends the chain; rows on a ring,
    and rows below one, have no top and no depth.
    """
    known = df.select(F.col(key).alias("__known"))
    rows = df.select(F.col(key).alias("node"), F.col(parent).alias("up"))
    rows = rows.join(known, F.col("up") == F.col("__known"), "left")
    # up: the next row to ask, NULL when ``top`` is known; depth: the rows passed so far
    above = F.col("__known")
    rows = rows.select("node", above.alias("up"), F.when(above.isNull(), F.col("node")).alias("top"), F.when(above.isNull(), 0).otherwise(1).cast("long").alias("depth"))
    moved = [F.col("__up").alias("up"), F.col("__top").alias("top"), (F.col("depth") + F.col("__depth")).alias("depth")]
    rows = _doubled(rows, ["top", "depth"], moved, "levels")
    depth = F.when(F.col("top").isNotNull(), F.col("depth"))
    return rows.select(F.col("node").alias(key), "top", depth.alias("depth"))


def below(df: DataFrame, key: str, parent: str, roots: DataFrame) -> DataFrame:
    """The keys of ``roots`` (its one column) and of all rows below any of them, at any distance.

    ``key`` is unique; a ring is followed once.
    """
    marked = roots.select(F.col(roots.columns[0]).alias("__root")).distinct()
    rows = df.select(F.col(key).alias("node"), F.col(parent).alias("up"))
    rows = rows.join(marked, F.col("node") == F.col("__root"), "left")
    # a row that is hit asks no further
    hit = F.col("__root").isNotNull()
    rows = rows.select("node", F.when(~hit, F.col("up")).alias("up"), hit.alias("hit"))
    told = F.coalesce("__hit", F.lit(False))
    moved = [F.when(~told, F.col("__up")).alias("up"), told.alias("hit")]
    rows = _doubled(rows, ["hit"], moved, "below")
    return rows.filter("hit").select(F.col("node").alias(key))


def _doubled(rows: DataFrame, carried: list[str], moved: list[Column], name: str) -> DataFrame:
    """``rows`` (node, up and ``carried``) when no row has anyone left to ask, or only rings are left.

    ``moved`` says what a row becomes from its own columns and those of the row it asks, named ``__``.
    """
    rounds = StoredTable.fresh(rows.sparkSession, name)
    rounds.write(rows)
    rows = rounds.read()
    for _ in range(rows.count().bit_length() + 1):  # a chain has no more rows than there are
        open_ = rows.filter(F.col("up").isNotNull())
        if open_.isEmpty():
            break
        asked = rows.select(*(F.col(c).alias(f"__{c}") for c in ("node", "up", *carried)))
        asking = open_.join(asked, F.col("up") == F.col("__node"), "left").select("node", *moved)
        rounds.write(asking.unionAll(rows.filter(F.col("up").isNull())))
        rounds.vacuum(keep=1)
        rows = rounds.read()
    return rows
