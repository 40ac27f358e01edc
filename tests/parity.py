"""Compare registered queries with their SQL, exactly and without order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark type names as DuckDB spells them.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), repr(v)) for v in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def difference(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree; otherwise what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for field in df.schema.fields:
        want = SAME_TYPE.get(field.dataType.simpleString())
        if want != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}"
    order = sorted(names)
    index = [names.index(n) for n in order]
    theirs = sorted((tuple(_plain(r[i]) for i in index) for r in cursor.fetchall()), key=_key)
    ours = sorted((tuple(_plain(v) for v in r) for r in df.select(*order).collect()), key=_key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"row {mine} != {other} (columns {order})"
    return None
