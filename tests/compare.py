"""Compare registered queries with their SQL twins."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb
import pyarrow as pa


def connect(folder: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def family(kind: pa.DataType) -> str:
    if pa.types.is_integer(kind):
        return str(kind)
    if pa.types.is_timestamp(kind):
        return f"timestamp{'_tz' if kind.tz else ''}"
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    return str(kind)


def _text(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0 if value else 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    """Empty if names, types and the multiset of rows agree."""
    names = sorted(spark_table.column_names)
    if names != sorted(sql_table.column_names):
        return [f"columns {names} / {sorted(sql_table.column_names)}"]
    out = []
    for c in names:
        a, b = family(spark_table.schema.field(c).type), family(sql_table.schema.field(c).type)
        if a != b:
            out.append(f"type of {c}: {a} / {b}")

    def rows(table: pa.Table):
        cells = [[_text(v) for v in table.column(c).to_pylist()] for c in names]
        return sorted(zip(*cells))

    left, right = rows(spark_table), rows(sql_table)
    if len(left) != len(right):
        out.append(f"rows {len(left)} / {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, first {names}: {bad[0][0]} / {bad[0][1]}")
    return out
