"""Stored tables: Spark catalog tables, one for each state of a table that changes.

The states of ``name`` are the managed tables ``name__1``, ``name__2``, ... of one database below the
shared folder; the largest number is the current one. A state is written under another name and
renamed when it is whole, and the catalog refuses a name that exists: readers see the old state or
the new one, and of two writers that worked from one state one fails. A reader that names a state
keeps it however often the table changes. Rows are added to the current state in place
with INSERT, which fills columns that are left out from their declared defaults.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablewright.session import shared_folder

DATABASE = "tablewright"


class ConcurrentChange(RuntimeError):
    """The table has changed since the state that a write was worked out from."""


class StoredTable:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{shared_folder(spark)}/{DATABASE}'")

    @classmethod
    def fresh(cls, spark: SparkSession, name: str) -> StoredTable:
        """A table that nobody else has."""
        return cls(spark, f"{name}_{uuid.uuid4().hex}")

    def states(self) -> list[int]:
        found = self.spark.sql(f"SHOW TABLES IN {DATABASE} LIKE '{self.name}__*'").collect()
        numbers = (re.fullmatch(re.escape(self.name.lower()) + r"__(\d+)", r.tableName) for r in found)
        return sorted(int(n[1]) for n in numbers if n)

    def state(self) -> int | None:
        """The current state, or None before the first write."""
        return max(self.states(), default=None)

    def table(self, state: int | None = None) -> str:
        """The catalog name of a state, the current one by default."""
        known = self.states()
        if not known or state not in (None, *known):
            what = "has not been populated" if state is None else f"has no state {state}"
            raise LookupError(f"{self.name} {what}")
        return f"{DATABASE}.{self.name}__{known[-1] if state is None else state}"

    def read(self, state: int | None = None) -> DataFrame:
        return self.spark.table(self.table(state))

    def write(
        self, df: DataFrame, after: int | None = None, partition_by: tuple[str, ...] = (), bucket_by: tuple[int, str] | None = None
    ) -> int:
        """Replace the whole table.

        ``after`` is the state that ``df`` was worked out from; if the table has moved on, nothing changes.
        ``bucket_by`` names a number of buckets and the column that rows are dealt and sorted by.
        """
        writer = df.write.format("parquet")
        if partition_by or bucket_by:
            # the catalog keeps the place of each partition, so such a state is written where it stays
            state = (self._next(after) or 0) + 1
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            if bucket_by:
                writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
            writer.saveAsTable(f"{DATABASE}.{self.name}__{state}")
            return state
        return self.publish(self.stage(df), after)

    def stage(self, df: DataFrame) -> str:
        """Write rows (which may come from older states) under a name of their own."""
        staged = f"{DATABASE}.{self.name}_staged_{uuid.uuid4().hex}"
        df.write.format("parquet").saveAsTable(staged)
        return staged

    def publish(self, staged: str, after: int | None = None) -> int:
        """Make staged rows the current state."""
        while True:
            state = (self._next(after) or 0) + 1
            try:
                self.spark.sql(f"ALTER TABLE {staged} RENAME TO {DATABASE}.{self.name}__{state}")
                return state
            except AnalysisException as e:
                if "ALREADY_EXISTS" not in str(e.getCondition()):
                    raise

    def discard(self, staged: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {staged}")

    def _next(self, after: int | None) -> int | None:
        now = self.state()
        if after not in (None, now):
            raise ConcurrentChange(f"{self.name} is at state {now}, not {after}")
        return now

    def append(self, new: DataFrame) -> int:
        """Add rows to the current state; columns left out take their default, or NULL.

        Names and types must be the table's. Without a table the rows become its first state.
        """
        state = self.state()
        if state is None:
            return self.write(new)
        held = {f.name: f.dataType.simpleString() for f in self.read(state).schema.fields}
        given = {f.name: f.dataType.simpleString() for f in new.schema.fields}
        if not given.items() <= held.items():
            raise ValueError(f"{self.name} holds {held}, not {given}")
        columns = ", ".join(f"`{c}`" for c in new.columns)
        self.spark.sql(f"INSERT INTO {self.table(state)} ({columns}) SELECT {columns} FROM {{rows}}", rows=new)
        return state

    def add_column(self, name: str, type_: str, default: str | None = None) -> None:
        """A new column of the current state: no file is rewritten, rows in old files have the default."""
        value = f" DEFAULT {default}" if default is not None else ""
        self.spark.sql(f"ALTER TABLE {self.table()} ADD COLUMNS (`{name}` {type_}{value})")

    def set_default(self, name: str, default: str | None) -> None:
        """What rows added from now on get; ``default`` is SQL, None drops it."""
        action = f"SET DEFAULT {default}" if default is not None else "DROP DEFAULT"
        self.spark.sql(f"ALTER TABLE {self.table()} ALTER COLUMN `{name}` {action}")

    def delete_in_partitions(self, where: Column, partition_by: tuple[str, ...]) -> int:
        """Delete rows of a partitioned table; only partitions that hold such rows are written again.

        Returns how many are. The partitions come to the driver, by their values, as many as the catalog lists.
        """
        doomed = F.coalesce(where, F.lit(False))
        rows, name = self.read(), self.table()
        told = rows.groupBy(*partition_by).agg(F.count("*").alias("__all"), F.count_if(doomed).alias("__doomed"))
        hit = told.filter("__doomed > 0").collect()
        kept = [r for r in hit if r["__doomed"] < r["__all"]]

        def inside(r: Row) -> Column:
            return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partition_by])

        if kept:
            chosen = reduce(lambda a, b: a | b, map(inside, kept))
            with _settings(self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
                # the new files replace those of the partitions they belong to when all are written
                rows.filter(chosen).filter(~doomed).write.insertInto(name, overwrite=True)
        for r in hit:
            if r not in kept:
                values = ", ".join(f"`{c}` = {_literal(r[c])}" for c in partition_by)
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({values})")
        return len(hit)

    def vacuum(self, keep: int) -> None:
        """Drop all but the newest ``keep`` states."""
        for state in self.states()[:-keep]:
            self.spark.sql(f"DROP TABLE {DATABASE}.{self.name}__{state}")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _literal(value: object) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """A copy of ``df`` as it is now, unmoved by later changes to what it reads."""
    table = StoredTable.fresh(df.sparkSession, name)
    table.write(df)
    return table.read()


def empty_like(df: DataFrame) -> DataFrame:
    """Same columns and types, no rows."""
    return df.filter(F.lit(False))
