"""Views, which are plans, and materialized views, which are stored results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.changes import insert, update, update_stored
from tablewright.operators.quality import IntegrityError, duplicates, outside_view
from tablewright.sources.ingest import fill_missing
from tablewright.sources.spec import ForeignKey, TableSpec
from tablewright.sources.stored import StoredTable


def create_view(df: DataFrame, name: str, replace: bool = False) -> DataFrame:
    """A named plan, computed anew on each read."""
    if replace:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)
    return df.sparkSession.table(name)


def rename_view(spark: SparkSession, old: str, new: str) -> DataFrame:
    spark.sql(f"ALTER VIEW `{old}` RENAME TO `{new}`")
    return spark.table(new)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


class TableView:
    """Some columns and rows of a stored table, through which the table is written.

    With ``checked`` (WITH CHECK OPTION) rows that the view would not show are refused.
    """

    def __init__(
        self, stored: StoredTable, spec: TableSpec, columns: list[str],
        where: Column | None = None, checked: bool = False,
    ):
        self.stored = stored
        self.spec = spec
        self.columns = columns
        self.where = F.lit(True) if where is None else where
        self.checked = checked

    def read(self) -> DataFrame:
        return self.stored.read().filter(self.where).select(*self.columns)

    def _known(self, names: list[str]) -> None:
        unknown = set(names) - set(self.columns)
        if unknown:
            raise ValueError(f"the view has no column {sorted(unknown)}")

    def _inside(self, rows: DataFrame) -> None:
        if self.checked and not outside_view(rows, self.where).isEmpty():
            raise IntegrityError("a row would lie outside the view")

    def insert(self, new: DataFrame, parents: dict[str, DataFrame] | None = None) -> int:
        """Add rows to the table; columns that the view does not show take their default."""
        self._known(new.columns)
        self._inside(fill_missing(new, self.spec))
        return insert(self.stored, new, self.spec, parents)

    def update(
        self, values: dict[str, Column], where: Column,
        parents: dict[str, DataFrame] | None = None, children: list[tuple[str, DataFrame, ForeignKey]] | None = None,
    ) -> int:
        """Change rows that the view shows, under the table's rules; the others keep their values."""
        self._known(list(values))
        chosen = F.coalesce(self.where & where, F.lit(False))
        self._inside(update(self.stored.read().filter(chosen), values))
        return update_stored(self.stored, values, chosen, self.spec, parents, children)


class MaterializedView:
    """The stored result of a plan; it changes only when refreshed.

    ``key`` names unique columns. With a key, a refresh checks the new result and leaves
    the old one in place if the key is not unique. Readers are never blocked: they keep
    the state they started with.
    """

    def __init__(self, stored: StoredTable, plan: Callable[[], DataFrame], key: list[str] | None = None):
        self.plan = plan
        self.key = key
        self._stored = stored

    def refresh(self) -> int:
        staged = self._stored.stage(self.plan())
        if self.key and not duplicates(self._stored.spark.table(staged), self.key, "unique").isEmpty():
            self._stored.discard(staged)
            raise IntegrityError(f"refresh refused: {self.key} is not unique")
        return self._stored.publish(staged)

    def read(self, state: int | None = None) -> DataFrame:
        """The current result; raises LookupError before the first refresh."""
        return self._stored.read(state)
