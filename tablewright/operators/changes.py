"""UPDATE and DELETE as functions from the old table to the new one.

Right-hand sides and conditions all see the old row. A condition that is NULL changes
nothing. Write the result as a new state with ``sources.stored.StoredTable``; ``insert`` and
``update_stored`` do so under the table's declared rules.
"""

from __future__ import annotations

from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.joins import distinct_keys, matched, unmatched
from tablewright.operators.quality import IntegrityError, insert_violations, refuse, update_violations
from tablewright.operators.subqueries import single_value
from tablewright.plans.hierarchy import below
from tablewright.sources.ingest import fill_missing
from tablewright.sources.spec import ForeignKey, TableSpec
from tablewright.sources.stored import StoredTable, empty_like, snapshot


def update(df: DataFrame, values: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Set columns, on the rows where the condition is true.

    Column types stay; a fraction assigned to an integer column is rounded.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name, value in values.items():
        value = (F.round(value) if isinstance(types[name], T.IntegralType) else value).cast(types[name])
        changed[name] = value if where is None else F.when(where, value).otherwise(F.col(name))
    return df.withColumns(changed)


def update_to_default(df: DataFrame, spec: TableSpec, column: str, where: Column) -> DataFrame:
    return update(df, {column: spec.default_of(column)}, where)


def update_by_key(df: DataFrame, key: str, changes: DataFrame, column: str) -> DataFrame:
    """Set ``column`` from ``changes(key, column)``; a NULL there sets NULL.

    A key that changes a row twice fails the job: an update never adds rows.
    """
    new, found = "__new", "__found"
    joined = single_value(df, key, changes, key, column, new, found)
    value = F.when(F.col(found), F.col(new)).otherwise(F.col(column))
    return joined.withColumn(column, value.cast(df.schema[column].dataType)).select(*df.columns)


def update_from_lookup(df: DataFrame, key: str, lookup: DataFrame, column: str, new: str) -> DataFrame:
    """Overwrite ``column`` on all rows with ``lookup(key, new)``; no match sets NULL.

    A matched key with more than one row in ``lookup`` fails the job.
    """
    joined = single_value(df.drop(column), key, lookup, key, new, column)
    return joined.withColumn(column, F.col(column).cast(df.schema[column].dataType)).select(*df.columns)


def delete(df: DataFrame, where: Column) -> DataFrame:
    return df.filter(~F.coalesce(where, F.lit(False)))


def delete_not_in(df: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """Delete rows whose ``column`` is NOT IN ``others``.

    A row stays if it has a match, or if the test is NULL: the column is NULL, or the set
    holds a NULL. An empty set deletes every row.
    """
    key, hit = "__key", "__hit"
    keys = distinct_keys(others.select(F.col(other).alias(key)), [key]).withColumn(hit, F.lit(True))
    unknown = others.exists() & (
        F.col(column).isNull() | others.filter(F.col(other).isNull()).exists()
    )
    joined = df.join(keys, F.col(column) == F.col(key), "left")
    return joined.filter(F.col(hit).isNotNull() | unknown).drop(key, hit)


def insert(
    stored: StoredTable, new: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None
) -> int:
    """INSERT under the declared rules: all rows are added, or none and IntegrityError raised.

    Only the new rows are checked, against each other, the keys in the table and the parents.
    """
    staged = stored.stage(fill_missing(new, spec))
    rows = stored.spark.table(staged)
    try:
        old = stored.read() if stored.state() else empty_like(rows)
        refuse(rows, insert_violations(old, rows, spec, parents))
        return stored.append(rows)
    finally:
        stored.discard(staged)


def update_stored(
    stored: StoredTable, values: dict[str, Column], where: Column, spec: TableSpec,
    parents: dict[str, DataFrame] | None = None, children: list[tuple[str, DataFrame, ForeignKey]] | None = None,
) -> int:
    """UPDATE under the declared rules: the table moves to a new state, or IntegrityError is raised.

    Only what the update touches is checked: the changed rows by their own rules; keys that are set, against
    each other and the unchanged rows; foreign keys that are set, against their parents; and keys
    that are given up, against ``children``, the tables that refer to this one.
    """
    state = stored.state()
    old = stored.read(state)
    chosen = F.coalesce(where, F.lit(False))
    refuse(old, update_violations(old, update(old.filter(chosen), values), chosen, list(values), spec, parents, children))
    return stored.write(update(old, values, chosen), after=state)


def split(df: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    """The rows a delete would remove, and the rows it would keep."""
    return df.filter(where), delete(df, where)


def move(df: DataFrame, where: Column, stored: StoredTable) -> tuple[DataFrame, DataFrame]:
    """Archive rows and delete them: both parts are written in one pass over the table."""
    flag = "__moved"
    moved = F.coalesce(where, F.lit(False)).cast("int")
    stored.write(df.withColumn(flag, moved), partition_by=(flag,))
    written = stored.read()
    return tuple(written.filter(F.col(flag) == n).drop(flag) for n in (1, 0))


# --- deleting parents -----------------------------------------------------------------


def cascade(
    child: DataFrame, fk: str | tuple[str, ...], deleted: DataFrame, key: str | tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """ON DELETE CASCADE: children kept, and children that go with their parent."""
    on = _on(fk, key)
    return unmatched(child, deleted, on), matched(child, deleted, on)


def blockers(
    deleted: DataFrame, key: str | tuple[str, ...], child: DataFrame, fk: str | tuple[str, ...]
) -> DataFrame:
    """ON DELETE RESTRICT / NO ACTION: the parents whose children forbid the delete."""
    return matched(deleted, child, _on(key, fk))


def _on(left: str | tuple[str, ...], right: str | tuple[str, ...]) -> dict[str, str]:
    return {left: right} if isinstance(left, str) else dict(zip(left, right))


def delete_restricted(parent: DataFrame, where: Column, key: str, child: DataFrame, fk: str) -> DataFrame:
    """Delete parents; if any of them has a child, delete none."""
    refused = blockers(parent.filter(where), key, child, fk).exists()
    return parent.filter(~F.coalesce(where, F.lit(False)) | refused)


def set_null(
    child: DataFrame, fk: str | tuple[str, ...], deleted: DataFrame, key: str | tuple[str, ...]
) -> DataFrame:
    """ON DELETE SET NULL: children keep their row and lose the key."""
    pairs = _on(fk, key)
    gone = {f: f"__gone{i}" for i, f in enumerate(pairs)}
    keys = deleted.select(*[F.col(pairs[f]).alias(g) for f, g in gone.items()])
    on = reduce(lambda a, b: a & b, [F.col(f) == F.col(g) for f, g in gone.items()])
    joined = child.join(distinct_keys(keys, list(gone.values())), on, "left")
    return joined.withColumns(
        {f: F.when(F.col(g).isNull(), F.col(f)) for f, g in gone.items()}
    ).select(*child.columns)


def delete_parents(
    tables: dict[str, tuple[DataFrame, TableSpec]], name: str, where: Column
) -> dict[str, DataFrame]:
    """Delete from a table and apply every foreign key's rule in the tables below it.

    Returns the new state of all tables, or raises before any of them is built: RESTRICT
    refuses when a child refers to a deleted row, NO ACTION when such a child remains.
    Along a hierarchy in one table, cascades are followed by pointer doubling, whatever its depth;
    where they come back over other tables, level by level.
    """
    try:
        doomed, after = _cascade_down(tables, name, where, _below(tables, name))
    except CycleError:
        doomed, after = _cascade_by_levels(tables, name, where)
    checks = []
    for parent in doomed:
        for child, fk in _references_to(tables, parent):
            if fk.on_delete == "set null":
                after[child] = set_null(after[child], fk.columns, doomed[parent], fk.parent_columns)
            elif fk.on_delete != "cascade":
                checks.append((parent, child, fk))
    for parent, child, fk in checks:
        holders = tables[child][0] if fk.on_delete == "restrict" else after[child]
        stuck = blockers(doomed[parent], fk.parent_columns, holders, fk.columns).limit(1).collect()
        if stuck:
            key = "|".join(str(stuck[0][c]) for c in fk.parent_columns)
            raise IntegrityError(f"{child} still refers to {parent} {key}")
    return after


def _references_to(
    tables: dict[str, tuple[DataFrame, TableSpec]], parent: str, rule: str | None = None
) -> list[tuple[str, ForeignKey]]:
    """Tables and their foreign keys to ``parent``, of one rule if it is named."""
    keys = [(child, fk) for child, (_, spec) in tables.items() for fk in spec.foreign_keys]
    return [(child, fk) for child, fk in keys if fk.parent == parent and rule in (None, fk.on_delete)]


States = dict[str, DataFrame]


def _cascade_down(
    tables: dict[str, tuple[DataFrame, TableSpec]], name: str, where: Column, order: list[str]
) -> tuple[States, States]:
    """Deleted rows and new states, with tables in an order that has parents before children."""
    doomed = {name: tables[name][0].filter(where)}
    after = {n: df for n, (df, _) in tables.items()}
    after[name] = delete(tables[name][0], where)
    for parent in order:
        own = _own_cascade(tables, parent)
        if own:
            df, key = tables[parent][0], tables[parent][1].primary_key[0]
            gone = below(df, key, own.columns[0], doomed[parent].select(key))
            # written by now, so the plans below it do not grow with the rounds
            doomed[parent], after[parent] = matched(df, gone, key), unmatched(df, gone, key)
        for child, fk in _references_to(tables, parent, "cascade"):
            if fk is own:
                continue
            rule = (fk.columns, doomed[parent], fk.parent_columns)
            after[child], _ = cascade(after[child], *rule)
            lost = matched(tables[child][0], doomed[parent], _on(fk.columns, fk.parent_columns))
            # a row may go for several reasons; repeats do no harm
            doomed[child] = doomed[child].unionByName(lost) if child in doomed else lost
    return doomed, after


def _own_cascade(tables: dict[str, tuple[DataFrame, TableSpec]], name: str) -> ForeignKey | None:
    """The one foreign key by which a table cascades to itself, if it is on its whole primary key of one column."""
    own = [fk for child, fk in _references_to(tables, name, "cascade") if child == name]
    simple = len(own) == 1 and len(own[0].columns) == 1 and own[0].parent_columns == tables[name][1].primary_key
    return own[0] if simple else None


def _cascade_by_levels(
    tables: dict[str, tuple[DataFrame, TableSpec]], name: str, where: Column
) -> tuple[States, States]:
    """As ``_cascade_down`` where cascades run in a cycle: one step of joins for each level.

    The keys of each level are written, so that plans do not grow with the depth. It ends
    when a level holds no row that was not found before. Tables need a primary key.
    """
    doomed: States = {}
    level = {name: tables[name][0].filter(where)}
    while level:
        held = {}
        for n, rows in level.items():
            if not tables[n][1].primary_key:
                raise ValueError(f"{n} needs a primary key: deletes cascade to it in a cycle")
            if n in doomed:
                rows = unmatched(rows, doomed[n], list(tables[n][1].primary_key))
            held[n] = snapshot(rows, f"doomed_{n}")
        held = {n: rows for n, rows in held.items() if not rows.isEmpty()}
        level = {}
        for parent, rows in held.items():
            doomed[parent] = doomed[parent].unionByName(rows) if parent in doomed else rows
            for child, fk in _references_to(tables, parent, "cascade"):
                lost = matched(tables[child][0], rows, _on(fk.columns, fk.parent_columns))
                level[child] = level[child].unionByName(lost) if child in level else lost
    after = {
        n: unmatched(df, doomed[n], list(spec.primary_key)) if n in doomed else df for n, (df, spec) in tables.items()
    }
    return doomed, after


def _below(tables: dict[str, tuple[DataFrame, TableSpec]], name: str) -> list[str]:
    """The table and those its deletes cascade to, parents before children."""
    children = {
        n: {c for c, fk in _references_to(tables, n, "cascade") if fk is not _own_cascade(tables, n)} for n in tables
    }
    reached, todo = set(), [name]
    while todo:
        n = todo.pop()
        if n not in reached:
            reached.add(n)
            todo += children[n]
    parents = {n: {p for p in reached if n in children[p]} for n in reached}
    return list(TopologicalSorter(parents).static_order())
