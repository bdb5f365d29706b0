"""Compare a query with its SQL on the same tables: row count, column types, values regardless of order."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

from tablewright.sources.trial import TABLES

TYPE_NAMES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _spark_type(name: str) -> str:
    if name.startswith("DECIMAL"):
        return name.lower().replace(" ", "")
    if name.endswith("[]"):
        return f"array<{_spark_type(name[:-2])}>"
    return TYPE_NAMES.get(name, name)


def _plain(value):
    if isinstance(value, float):
        return ("f", repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def compare(spark_df, con, sql: str) -> list[str]:
    """Problems found; an empty list means the results are equal."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = [_spark_type(str(d[1])) for d in cursor.description]
    rows = cursor.fetchall()
    problems = []
    want_types = dict(zip(columns, kinds))
    have_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    if want_types != have_types:
        problems.append(f"types: spark {have_types} sql {want_types}")
    names = sorted(want_types)
    if sorted(have_types) != names:
        return problems
    order = [columns.index(n) for n in names]
    want = Counter(tuple(_plain(row[i]) for i in order) for row in rows)
    have = Counter(tuple(_plain(row[n]) for n in names) for row in spark_df.select(*names).collect())
    if sum(want.values()) != sum(have.values()):
        problems.append(f"rows: spark {sum(have.values())} sql {sum(want.values())}")
    if want != have:
        problems.append(f"only spark {list((have - want).items())[:3]} only sql {list((want - have).items())[:3]}")
    return problems
