"""Declared tables: columns, defaults and integrity rules, and how they change.

Spark keeps names and types with a DataFrame but not defaults, lengths, keys or checks,
so those live in a ``TableSpec`` next to the data. Every schema change takes a DataFrame
and its spec and returns both anew.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type names and the Spark types that hold them. TIME is kept as seconds since
# midnight; a bare NUMERIC keeps its fraction instead of rounding to whole numbers.
_PLAIN_TYPES = {
    "serial": "int",
    "bigserial": "bigint",
    "int": "int",
    "integer": "int",
    "smallint": "smallint",
    "bigint": "bigint",
    "numeric": "decimal(38,18)",
    "text": "string",
    "boolean": "boolean",
    "date": "date",
    "time": "int",
    "timestamp": "timestamp_ntz",
    "timestamptz": "timestamp",
    "interval": "interval day to second",
}
_SIZED_TYPE = re.compile(r"(varchar|char|numeric|decimal)\((\d+)(?:\s*,\s*(\d+))?\)")


def spark_type(declared: str) -> str:
    declared = declared.strip().lower()
    if declared in _PLAIN_TYPES:
        return _PLAIN_TYPES[declared]
    sized = _SIZED_TYPE.fullmatch(declared)
    if not sized:
        raise ValueError(f"unknown type {declared!r}")
    kind, size, scale = sized.groups()
    return "string" if kind in ("varchar", "char") else f"decimal({size},{scale or 0})"


def length_limit(declared: str) -> int | None:
    sized = _SIZED_TYPE.fullmatch(declared.strip().lower())
    return int(sized[2]) if sized and sized[1] in ("varchar", "char") else None


def is_char(declared: str) -> bool:
    return declared.strip().lower().startswith("char(")


def cast_to(column: Column, declared: str, source_is_integral: bool = False) -> Column:
    """Assignment cast: numbers round into integer columns, CHAR loses its trailing blanks."""
    target = spark_type(declared)
    if target in ("int", "smallint", "bigint") and not source_is_integral:
        return F.round(column).cast(target)
    if is_char(declared):
        return F.rtrim(column.cast(target))
    return column.cast(target)


@dataclass(frozen=True)
class Default:
    """The explicit DEFAULT marker in a literal row."""


DEFAULT = Default()


@dataclass(frozen=True)
class Computed:
    """A default worked out when a row is added, such as ``Computed("current_date()")``."""

    expression: str


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    default: Any = None  # a plain value or Computed


@dataclass(frozen=True)
class Check:
    """A rule that a row breaks only when the condition is false; NULL passes."""

    name: str
    condition: str


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_delete: str = "no action"  # or: restrict, cascade, set null


def references(
    columns: str | tuple[str, ...], parent: TableSpec, on_delete: str = "no action"
) -> ForeignKey:
    """A foreign key to the parent's primary key."""
    columns = (columns,) if isinstance(columns, str) else columns
    if len(columns) != len(parent.primary_key):
        raise ValueError(f"{columns} does not fit the key {parent.primary_key} of {parent.name}")
    return ForeignKey(columns, parent.name, parent.primary_key, on_delete)


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: tuple[Check, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def serial(self) -> str | None:
        """The column whose keys are handed out to new rows."""
        return next((f.name for f in self.fields if f.type.lower() in ("serial", "bigserial")), None)

    def __getitem__(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(
            ", ".join(f"`{f.name}` {spark_type(f.type)}" for f in self.fields)
        )

    def default_of(self, name: str) -> Column:
        f = self[name]
        computed = isinstance(f.default, Computed)
        value = F.expr(f.default.expression) if computed else F.lit(f.default)
        return value.cast(spark_type(f.type))

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the declared columns, cast to the declared types."""
        integral = {
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        }
        return df.select(
            *[
                cast_to(F.col(f.name), f.type, f.name in integral).alias(f.name)
                for f in self.fields
            ]
        )


def table(name: str, columns: str, **rules: Any) -> TableSpec:
    """Shorthand: ``table("t", "id int!, name varchar(50), qty int = 0")``.

    ``!`` marks NOT NULL; ``= value`` is a constant default and ``= f()`` a computed one.
    """
    fields = []
    for part in re.split(r",\s*(?![^(]*\))", columns.strip()):
        declared, _, default = (p.strip() for p in part.partition("="))
        column, _, type_ = declared.rstrip("!").partition(" ")
        fields.append(Field(column, type_.strip(), not declared.endswith("!"), _value(default)))
    return TableSpec(name, tuple(fields), **rules)


def _value(text: str) -> Any:
    if not text:
        return None
    if text.endswith("()"):
        return Computed(text)
    return {"true": True, "false": False}.get(text.lower(), text.strip("'"))


# --- schema changes -------------------------------------------------------------------


@dataclass(frozen=True)
class AddColumn:
    field: Field


@dataclass(frozen=True)
class DropColumn:
    name: str


@dataclass(frozen=True)
class SetType:
    name: str
    type: str


@dataclass(frozen=True)
class SetDefault:
    name: str
    default: Any


Change = AddColumn | DropColumn | SetType | SetDefault


def alter(df: DataFrame, spec: TableSpec, *changes: Change) -> tuple[DataFrame, TableSpec]:
    """Apply all changes in one projection, or none if one of them is invalid.

    Existing rows take the default of an added column; a computed default is worked out
    here, once, so that all of them share one value whenever they are read. A type change
    is an ANSI cast, so a value that does not fit fails the job that runs the plan.
    """
    fields = {f.name: f for f in spec.fields}
    values: dict[str, Column] = {f.name: F.col(f.name) for f in spec.fields}
    for change in changes:
        if isinstance(change, AddColumn):
            name = change.field.name
            if name in fields:
                raise ValueError(f"column {name!r} exists already")
            fields[name] = change.field
            values[name] = TableSpec("", (change.field,)).default_of(name)
            if isinstance(change.field.default, Computed):
                values[name] = _value_now(df.sparkSession, values[name], change.field.type)
            continue
        if change.name not in fields:
            raise ValueError(f"no column {change.name!r}")
        if isinstance(change, DropColumn):
            del fields[change.name], values[change.name]
        elif isinstance(change, SetType):
            was = fields[change.name].type
            if is_char(was):
                values[change.name] = F.rtrim(values[change.name])
            if change.type.lower() == "smallint" and spark_type(was) == "int":
                values[change.name] = values[change.name].cast("smallint")
            else:
                values[change.name] = cast_to(values[change.name], change.type)
            fields[change.name] = replace(fields[change.name], type=change.type)
        else:
            fields[change.name] = replace(fields[change.name], default=change.default)
    changed = df.select(*[values[n].alias(n) for n in fields])
    return changed, replace(spec, fields=tuple(fields.values()))


def _value_now(spark: SparkSession, value: Column, declared: str) -> Column:
    # as text, because a timestamp would come back in Python's time zone
    text = spark.range(1).select(value.cast("string")).first()[0]
    return F.lit(text).cast(spark_type(declared))
