"""Runs a query and its SQL on the same tables and compares names, types and values."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            return f"type of {name}: {kind} against {types[name]}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, cursor.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} against {b}"
    return None
