"""Compare a Spark result with its DuckDB twin, rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from read_parquet('{files}')")
    return con


# DuckDB types of the Spark types that results have.
TWIN_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(rows, order) -> Counter:
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> tuple[int, str]:
    """(number of rows, first difference or an empty text)."""
    rows = [tuple(r) for r in frame.collect()]
    names = frame.columns
    cursor = con.execute(sql)
    twin_names = [c[0] for c in cursor.description]
    twin_types = {c[0]: str(c[1]) for c in cursor.description}
    twin = cursor.fetchall()
    if sorted(names) != sorted(twin_names):
        return len(rows), f"columns {sorted(names)} / {sorted(twin_names)}"
    for name, kind in frame.dtypes:
        if TWIN_TYPES.get(kind) != twin_types[name]:
            return len(rows), f"type of {name}: {kind} / {twin_types[name]}"
    ours = bag(rows, [names.index(n) for n in sorted(names)])
    theirs = bag(twin, [twin_names.index(n) for n in sorted(names)])
    if ours == theirs:
        return len(rows), ""
    more, less = ours - theirs, theirs - ours
    return len(rows), (
        f"{sum(ours.values())} rows, twin {sum(theirs.values())}; "
        f"only ours {list(more)[:2]}; only twin {list(less)[:2]}"
    )
