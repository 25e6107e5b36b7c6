"""Adding rows to a table: literal rows, defaults, selected rows, generated keys."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.plans.order import number_rows
from tablewright.plans.prefix import dense_keys
from tablewright.sources.spec import DEFAULT, TableSpec, cast_to, spark_type


def literal_rows(
    spark: SparkSession, spec: TableSpec, rows: Sequence[Sequence[Any]], columns: list[str] | None = None
) -> DataFrame:
    """VALUES: rows for the named columns (all, by position, when none are named).

    A left-out column and a ``DEFAULT`` marker take the declared default or NULL; an
    explicit None stays NULL. A value may be a Column such as ``F.current_date()``.
    """
    columns = columns or spec.columns
    structs = []
    for row in rows:
        if len(row) != len(columns):
            raise ValueError(f"{len(row)} values for {len(columns)} columns of {spec.name}")
        given = dict(zip(columns, row))
        values = [_value(spec, n, given.get(n, DEFAULT)).alias(n) for n in spec.columns]
        structs.append(F.struct(*values))
    if not structs:
        return spec.empty(spark)
    return spark.range(1).select(F.inline(F.array(*structs)))


def _value(spec: TableSpec, name: str, value: Any) -> Column:
    if value is DEFAULT:
        return spec.default_of(name)
    column = value if isinstance(value, Column) else F.lit(value)
    if value is None:
        return column.cast(spark_type(spec[name].type))
    # a string is a literal of the target type, not a number to round
    return cast_to(column, spec[name].type, source_is_integral=isinstance(value, (str, int)))


def fill_missing(new: DataFrame, spec: TableSpec) -> DataFrame:
    """Give rows of a column subset all declared columns, in order and with declared types."""
    missing = [f.name for f in spec.fields if f.name not in new.columns]
    return spec.conform(new.withColumns({name: spec.default_of(name) for name in missing}))


def append(df: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """INSERT INTO ... (columns) SELECT: missing columns get their default or NULL."""
    unknown = set(new.columns) - set(spec.columns)
    if unknown:
        raise ValueError(f"{spec.name} has no column {sorted(unknown)}")
    return df.unionByName(fill_missing(new, spec))


def append_by_position(df: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """INSERT INTO ... SELECT without a column list; the column counts must agree."""
    if len(new.columns) != len(spec.columns):
        raise ValueError(f"{len(new.columns)} values for {len(spec.columns)} columns of {spec.name}")
    return append(df, new.toDF(*spec.columns), spec)


def append_copies_unless(df: DataFrame, probe: DataFrame, spec: TableSpec, **values: Any) -> DataFrame:
    """INSERT ... SELECT constants FROM table WHERE NOT EXISTS (probe).

    Adds one copy per row already in the table, or none when ``probe`` has a row. A serial
    key that is not given counts on from the table's largest.
    """
    constants = [F.lit(v).alias(k) for k, v in values.items()]
    chosen = df.filter(~probe.exists())
    if not spec.serial or spec.serial in values:
        return append(df, chosen.select(*constants), spec)
    order = "__order"
    return append_keyed(df, chosen.select(F.col(spec.serial).alias(order), *constants), spec, order)


def insert_if_absent(df: DataFrame, probe: DataFrame, spec: TableSpec, **values: Any) -> DataFrame:
    """Add one row unless ``probe`` has a row; a serial key is given as in ``append_keyed``."""
    constants = [F.lit(v).alias(k) for k, v in values.items()]
    if spec.serial and spec.serial not in values:
        constants.append(next_key(df, spec.serial).alias(spec.serial))
    one = df.sparkSession.range(1).filter(~probe.exists()).select(*constants)
    return append(df, one, spec)


def next_key(df: DataFrame, key: str) -> Column:
    """The key after the largest in the table; 1 for an empty one."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)) + 1).scalar()


def append_keyed(
    df: DataFrame, new: DataFrame, spec: TableSpec, order_by: str | list[str], start: int | None = None
) -> DataFrame:
    """Add rows that come without the table's serial key, which they get in the order of ``order_by``.

    Keys begin at ``start``, or after the table's largest. ``order_by`` need not be a column
    of the table.
    """
    first = next_key(df, spec.serial) if start is None else start
    keyed = assign_keys(new, order_by, spec.serial, first)
    foreign = {order_by} if isinstance(order_by, str) else set(order_by)
    return append(df, keyed.drop(*(foreign - set(spec.columns))), spec)


def assign_keys(new: DataFrame, order_by: str | list[str], key: str, start: int | Column = 1) -> DataFrame:
    """Give new rows consecutive keys from ``start``.

    The order is that of a unique bigint, or of one or more columns of any sortable type, NULL first; rows
    that these do not tell apart get their keys in any order. The keyed rows are the answer to
    "which keys were just assigned": filter or join them. Keys that callers set themselves do not move ``start``.
    """
    if isinstance(order_by, str) and new.schema[order_by].dataType.typeName() in ("long", "integer", "short", "byte"):
        return dense_keys(new, order_by, key, start)
    columns = [order_by] if isinstance(order_by, str) else order_by
    return number_rows(new, [F.col(c).asc_nulls_first() for c in columns], key, start)
