"""Compare a Spark result with DuckDB's, by column names, types and all values."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(t: pa.Table) -> tuple[list[tuple[str, str]], list[tuple]]:
    names = sorted(t.column_names)
    types = []
    for n in names:
        type_ = t.schema.field(n).type
        if pa.types.is_timestamp(type_):
            type_ = pa.timestamp("us")
        if pa.types.is_large_string(type_):
            type_ = pa.string()
        types.append((n, str(type_)))
    rows = list(zip(*[t.column(n).to_pylist() for n in names]))
    return types, sorted(rows, key=repr)


def differences(spark_df, con, sql: str, types: bool = True) -> list[str]:
    got_types, got = canonical(spark_df.toArrow())
    want_types, want = canonical(con.sql(sql).to_arrow_table())
    out = []
    if types and got_types != want_types:
        out.append(f"types: {[x for x in zip(got_types, want_types) if x[0] != x[1]]}")
    if [n for n, _ in got_types] != [n for n, _ in want_types]:
        out.append("column names differ")
    if len(got) != len(want):
        out.append(f"rows: {len(got)} for {len(want)}")
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w][:3]
        out.append(f"values: {bad}")
    return out
