"""Integrity rules as jobs that return the rows breaking them.

Result columns are ``rule``, ``key`` (the row's key, or the offending key value) and
``detail``. All rules that look at one row share a single scan. Uniqueness is a grouped
count and a foreign key an anti join on distinct values, so a value that a third of all
rows carry is one row before any shuffle.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.joins import matched, unmatched
from tablewright.sources.spec import ForeignKey, TableSpec, is_char, length_limit

SCHEMA = "rule string, key string, detail string"


class IntegrityError(ValueError):
    pass


def text(columns: list[str] | tuple[str, ...]) -> Column:
    """Key values as text, parts joined by ``|``."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def broken(condition: Column) -> Column:
    """True when a CHECK fails; a NULL condition passes."""
    return ~F.coalesce(condition, F.lit(True))


def too_long(column: str, declared: str) -> Column:
    value = F.rtrim(F.col(column)) if is_char(declared) else F.col(column)
    return F.coalesce(F.length(value) > length_limit(declared), F.lit(False))


def does_not_fit(value: Column, declared: str) -> Column:
    """True when a number overflows NUMERIC(p,s) after rounding to s places."""
    return value.isNotNull() & value.try_cast(declared).isNull()


def _always_fits(held: T.DataType, target: T.DecimalType) -> bool:
    return (
        isinstance(held, T.DecimalType)
        and held.scale <= target.scale
        and held.precision - held.scale <= target.precision - target.scale
    )


def row_rules(df: DataFrame, rules: dict[str, tuple[Column, Column]], key: list[str]) -> DataFrame:
    """Violations of per-row rules, in one scan: ``{rule: (broken, detail)}``."""
    hits = [
        F.when(is_broken, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
        for rule, (is_broken, detail) in rules.items()
    ]
    # most rows break nothing: drop them before any array or text is built
    suspects = df.filter(reduce(lambda a, b: a | b, [is_broken for is_broken, _ in rules.values()]))
    return suspects.select(
        text(key).alias("key"), F.explode(F.array_compact(F.array(*hits))).alias("hit")
    ).select("hit.rule", "key", "hit.detail")


def duplicates(df: DataFrame, columns: list[str], rule: str) -> DataFrame:
    """Key values held by more than one row; a NULL part exempts the row."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count("*").alias("__n"))
        .filter(F.col("__n") > 1)
        .select(F.lit(rule).alias("rule"), text(columns).alias("key"), F.col("__n").cast("string").alias("detail"))
    )


def dangling(child: DataFrame, fk: ForeignKey, parent: DataFrame, rule: str) -> DataFrame:
    """Foreign key values without a parent, and how many rows hold each."""
    used = child.dropna(subset=list(fk.columns)).groupBy(*fk.columns).agg(F.count("*").alias("__n"))
    renamed = parent.select(*[F.col(c).alias(f"__p{i}") for i, c in enumerate(fk.parent_columns)])
    lost = unmatched(used, renamed, {c: f"__p{i}" for i, c in enumerate(fk.columns)})
    return lost.select(F.lit(rule).alias("rule"), text(fk.columns).alias("key"), F.col("__n").cast("string").alias("detail"))


def own_rules(df: DataFrame, spec: TableSpec) -> dict[str, tuple[Column, Column]]:
    """The rules that look at one row: ``{rule: (broken, detail)}``."""
    rules: dict[str, tuple[Column, Column]] = {}
    for f in spec.fields:
        if not f.nullable or f.name in spec.primary_key:
            rules[f"{spec.name}.{f.name} not null"] = (F.col(f.name).isNull(), F.lit("NULL"))
        if length_limit(f.type):
            rules[f"{spec.name}.{f.name} {f.type}"] = (too_long(f.name, f.type), F.col(f.name))
        target = spec.schema[f.name].dataType
        limited = isinstance(target, T.DecimalType) and "(" in f.type  # bare NUMERIC has no limit
        if limited and not _always_fits(df.schema[f.name].dataType, target):
            rules[f"{spec.name}.{f.name} {f.type}"] = (
                does_not_fit(F.col(f.name), target.simpleString()),
                F.col(f.name),
            )
    for check in spec.checks:
        rules[f"{spec.name} check {check.name}"] = (broken(F.expr(check.condition)), F.lit(check.condition))
    return rules


def key_of(spec: TableSpec) -> list[str]:
    """What names a row in a report."""
    return list(spec.primary_key or spec.columns[:1])


def validate(
    df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None, keyed: bool = True
) -> DataFrame:
    """All violations of a table's declared rules; ``keyed`` tells whether the primary key is looked at."""
    rules = own_rules(df, spec)
    parts = [row_rules(df, rules, key_of(spec))] if rules else []
    if spec.primary_key and keyed:
        parts.append(duplicates(df, list(spec.primary_key), f"{spec.name} primary key"))
    for columns in spec.unique:
        parts.append(duplicates(df, list(columns), f"{spec.name} unique {','.join(columns)}"))
    for fk in spec.foreign_keys:
        rule = f"{spec.name} foreign key {','.join(fk.columns)}"
        parts.append(dangling(df, fk, (parents or {})[fk.parent], rule))
    if not parts:
        return df.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, parts)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def validate_all(tables: dict[str, tuple[DataFrame, TableSpec]]) -> DataFrame:
    """All violations of the rules of tables that refer to each other, from one scan of each and one shuffle.

    A row gives facts: the rules of one row that it breaks, the keys that it holds, and those that it
    refers to. The facts of all tables meet in one aggregate, where a hot value is one row for each task:
    a key that is held twice, or referred to and not held, breaks its rule. The result is that of
    ``validate`` for each table.
    """
    spaces: list[tuple[str, tuple[str, ...]]] = []  # keys, as the table that holds them and its columns
    for name, (_, spec) in tables.items():
        keys = [*([spec.primary_key] if spec.primary_key else []), *spec.unique]
        spaces += [(name, key) for key in keys]
        spaces += [(fk.parent, fk.parent_columns) for fk in spec.foreign_keys]
    spaces = list(dict.fromkeys(spaces))
    uses = [(name, fk) for name, (_, spec) in tables.items() for fk in spec.foreign_keys]
    row_names = [rule for df, spec in tables.values() for rule in own_rules(df, spec)]
    facts = [_facts(name, tables, spaces, uses, row_names) for name in tables]
    used = [F.count_if(F.col("role") == i).alias(f"used_{i}") for i in range(len(uses))]
    met = reduce(DataFrame.unionAll, facts).groupBy("space", "k1", "k2", "text", "detail")
    met = met.agg(F.count_if("held").alias("held"), *used)
    shown = F.coalesce("detail", F.concat_ws("|", "k1", "k2"))
    hits = []
    for i, (name, columns) in enumerate(spaces):
        spec = tables[name][1]
        if columns == spec.primary_key or columns in spec.unique:
            kind = "primary key" if columns == spec.primary_key else f"unique {','.join(columns)}"
            hits.append(_hit((F.col("space") == i) & (F.col("held") > 1), f"{name} {kind}", shown, "held"))
    for i, (name, fk) in enumerate(uses):
        lost = (F.col("space") == spaces.index((fk.parent, fk.parent_columns))) & (F.col("held") == 0) & (F.col(f"used_{i}") > 0)
        hits.append(_hit(lost, f"{name} foreign key {','.join(fk.columns)}", shown, f"used_{i}"))
    of_row = F.col("space") >= len(spaces)
    rule = F.element_at(F.array(*map(F.lit, row_names)), F.col("space") - len(spaces) + 1) if row_names else F.lit(None)
    broken_row = F.struct(rule.alias("rule"), F.col("text").alias("key"), "detail")
    # equal rows break a rule as often as they occur
    found = F.when(of_row, F.array_repeat(broken_row, F.col("held").cast("int"))).otherwise(F.array(*hits))
    suspects = met.filter(of_row | (F.col("held") != 1))
    return suspects.select(F.explode(found).alias("x")).filter("x is not null").select("x.rule", "x.key", "x.detail")


def _hit(condition: Column, rule: str, key: Column, count: str) -> Column:
    hit = F.struct(F.lit(rule).alias("rule"), key.alias("key"), F.col(count).cast("string").alias("detail"))
    return F.when(condition, hit)


def _facts(
    name: str, tables: dict[str, tuple[DataFrame, TableSpec]], spaces: list[tuple[str, tuple[str, ...]]],
    uses: list[tuple[str, ForeignKey]], row_names: list[str],
) -> DataFrame:
    """space, k1, k2, text, detail, held, role: what the rows of a table hold, refer to and break.

    Whole numbers are compared as such, in k1 and k2; other keys as ``text``, each part with its length, and
    shown as ``detail``. No lambda is near the rows: with one, Spark interprets all of an array for each row.
    What a row breaks is built for the few rows that break anything.
    """
    df, spec = tables[name]
    none = F.lit(None)

    def made(space: int, k1: Column, k2: Column, text: Column, detail: Column, role: int | None, breaches: Column) -> Column:
        return F.struct(
            F.lit(space).alias("space"), k1.cast("bigint").alias("k1"), k2.cast("bigint").alias("k2"),
            text.cast("string").alias("text"), detail.cast("string").alias("detail"), F.lit(role is None).alias("held"),
            F.lit(role).cast("int").alias("role"), breaches.cast("array<struct<space:int,detail:string>>").alias("breaches"),
        )

    def fact(space: int, columns: tuple[str, ...], role: int | None) -> Column:
        owner, key = spaces[space]
        types = [tables[owner][0].schema[c].dataType for c in key]
        whole = len(key) <= 2 and all(isinstance(t, _INTEGRAL) for t in types)
        values = [F.col(c).cast(t) for c, t in zip(columns, types)]
        k1, k2 = values + [none] * (2 - len(values)) if whole else (none, none)
        parts = [v.cast("string") for v in values]
        as_text = none if whole else F.concat(*(F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in parts))
        shown = none if whole else F.concat_ws("|", *parts)
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        return F.when(known, made(space, k1, k2, as_text, shown, role, none))

    facts = [fact(i, columns, None) for i, (owner, columns) in enumerate(spaces) if owner == name]
    facts += [fact(spaces.index((fk.parent, fk.parent_columns)), fk.columns, i) for i, (child, fk) in enumerate(uses) if child == name]
    rules = own_rules(df, spec)
    if rules:
        breaches = [
            F.when(is_broken, F.struct(F.lit(len(spaces) + row_names.index(rule)).alias("space"), detail.cast("string").alias("detail")))
            for rule, (is_broken, detail) in rules.items()
        ]
        any_broken = reduce(lambda a, b: a | b, [is_broken for is_broken, _ in rules.values()])
        facts.append(F.when(any_broken, made(-1, none, none, text(key_of(spec)), none, None, F.array(*breaches))))
    if not facts:
        facts = [F.when(F.lit(False), made(-1, none, none, none, none, None, none))]
    found = df.select(F.explode(F.array(*facts)).alias("x")).filter("x is not null").select("x.*")
    each = found.select("*", F.explode_outer("breaches").alias("breach")).filter("breaches is null or breach is not null")
    space, detail = F.coalesce("breach.space", "space").alias("space"), F.coalesce("breach.detail", "detail").alias("detail")
    return each.select(space, "k1", "k2", "text", detail, "held", "role")


def insert_violations(
    old: DataFrame, new: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The rules that rows to be added break: their own, and keys that the table holds already."""
    parents = {**(parents or {}), spec.name: old.unionByName(new)}
    parts = [validate(new, spec, parents)]
    for columns in filter(None, (spec.primary_key, *spec.unique)):
        kind = "primary key" if columns == spec.primary_key else f"unique {','.join(columns)}"
        taken = matched(new, old, list(columns))
        parts.append(
            taken.select(F.lit(f"{spec.name} {kind}").alias("rule"), text(columns).alias("key"), F.lit("taken").alias("detail"))
        )
    return reduce(DataFrame.unionByName, parts)


def update_violations(
    old: DataFrame, changed: DataFrame, chosen: Column, assigned: list[str], spec: TableSpec,
    parents: dict[str, DataFrame] | None = None, children: list[tuple[str, DataFrame, ForeignKey]] | None = None,
) -> DataFrame:
    """The rules that an update breaks; ``changed`` are the new images of the rows ``chosen`` from ``old``.

    Keys and foreign keys that hold no assigned column are as good as before and are not looked at.
    """
    touched = set(assigned)
    kept = old.filter(~chosen)
    own = replace(
        spec,
        unique=tuple(u for u in spec.unique if touched & set(u)),
        foreign_keys=tuple(fk for fk in spec.foreign_keys if touched & set(fk.columns)),
    )
    parents = {**(parents or {}), spec.name: kept.unionByName(changed)}
    parts = [validate(changed, own, parents, keyed=bool(touched & set(spec.primary_key)))]
    keys = [("primary key", spec.primary_key)] if touched & set(spec.primary_key) else []
    for kind, columns in [*keys, *((f"unique {','.join(u)}", u) for u in own.unique)]:
        taken = matched(changed, kept, list(columns))
        parts.append(
            taken.select(F.lit(f"{spec.name} {kind}").alias("rule"), text(columns).alias("key"), F.lit("taken").alias("detail"))
        )
    # the table's own rows may refer to it as well, by a key that the update gives up
    itself = [(spec.name, parents[spec.name], fk) for fk in spec.foreign_keys if fk.parent == spec.name]
    for name, child, fk in [*(children or []), *itself]:
        if touched & set(fk.parent_columns):
            given_up = unmatched(old.filter(chosen), parents[spec.name], list(fk.parent_columns))
            stuck = matched(given_up, child, dict(zip(fk.parent_columns, fk.columns)))
            rule = f"{name} foreign key {','.join(fk.columns)}"
            parts.append(
                stuck.select(F.lit(rule).alias("rule"), text(fk.parent_columns).alias("key"), F.lit("still referred to").alias("detail"))
            )
    return reduce(DataFrame.unionByName, parts)


def enforce(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Return ``df``, or raise with a few examples when any rule is broken."""
    return refuse(df, validate(df, spec, parents))


def refuse(df: DataFrame, violations: DataFrame) -> DataFrame:
    examples = violations.limit(5).collect()  # for the message only; any row refuses all
    if examples:
        raise IntegrityError("; ".join(f"{r.rule}: {r.key} ({r.detail})" for r in examples))
    return df


def outside_view(new: DataFrame, predicate: Column) -> DataFrame:
    """Rows that a filtered view would not show (WITH CHECK OPTION); NULL is outside."""
    return new.filter(~F.coalesce(predicate, F.lit(False)))
