"""Run a registered query and its SQL on the same tables and compare."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(kind: pa.DataType) -> str:
    text = str(kind)
    return "string" if text in ("large_string", "string_view") else text


def _cell(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else (value + 0.0,)
    return value


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*[[_cell(v) for v in c] for c in columns]), key=repr)


def types_of(table: pa.Table) -> dict[str, str]:
    return {f.name: _plain(f.type) for f in table.schema}


def differences(actual: pa.Table, expected: pa.Table) -> list[str]:
    found = []
    if types_of(actual) != types_of(expected):
        a, e = types_of(actual), types_of(expected)
        keys = sorted(set(a) | set(e))
        found.append(f"schema: {[(k, a.get(k), e.get(k)) for k in keys if a.get(k) != e.get(k)]}")
    if actual.num_rows != expected.num_rows:
        found.append(f"rows: {actual.num_rows} against {expected.num_rows}")
    if not found:
        pairs = zip(rows_of(actual), rows_of(expected))
        wrong = [(a, e) for a, e in pairs if a != e]
        if wrong:
            found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return found
