"""Run a registered query and its SQL twin and compare them as sets of rows."""

from __future__ import annotations

import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Row count, and a description of the first difference if there is one."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]).upper() for d in found.description}
    expected = _rows(names, found.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return len(actual), f"columns {sorted(df.columns)} != {sorted(names)}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}
    for name, kind in df.dtypes:
        if same.get(kind) != kinds[name]:
            return len(actual), f"type of {name}: {kind} != {kinds[name]}"
    if len(actual) != len(expected):
        return len(actual), f"rows {len(actual)} != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return len(actual), f"{a} != {e}"
    return len(actual), None
