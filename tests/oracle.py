"""Compare a Spark result with the checking SQL the way the driver does: names, types, rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def differences(df, con, sql: str) -> list[str]:
    found = []
    result = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    expected_rows = result.fetchall()
    names = sorted(df.columns)
    if names != sorted(expected_types):
        return [f"columns {names} != {sorted(expected_types)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != expected_types[name]:
            found.append(f"type of {name}: {kind} != {expected_types[name]}")
    order = {name: i for i, name in enumerate(expected_types)}
    want = Counter(tuple(plain(r[order[n]]) for n in names) for r in expected_rows)
    got = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    if want != got:
        missing, extra = list((want - got).elements()), list((got - want).elements())
        found.append(
            f"rows {sum(got.values())} != {sum(want.values())}; columns {names}; "
            f"missing {len(missing)} e.g. {sorted(missing, key=str)[:2]}; extra {len(extra)} e.g. {sorted(extra, key=str)[:2]}"
        )
    return found
