"""Runs registered queries next to their DuckDB SQL and compares names, types and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v, digits=None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{digits}g}") if digits else v
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    return v


def rows_of(names, rows, digits=None):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i], digits) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


KIND = {"bigint": "int", "int": "int", "integer": "int", "smallint": "int", "tinyint": "int", "hugeint": "huge",
        "double": "double", "float": "float", "string": "str", "varchar": "str", "boolean": "bool", "date": "date",
        "timestamp": "ts", "timestamp_ntz": "ts", "timestamp with time zone": "tstz"}


def compare(name, spark_df, con, sql):
    """Empty string when equal, else what differs."""
    got = spark_df.collect()
    cur = con.execute(sql)
    want = cur.fetchall()
    want_names = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]).lower() for d in cur.description}
    if sorted(spark_df.columns) != sorted(want_names):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_names)}"
    problems = []
    for c, t in spark_df.dtypes:
        a, b = KIND.get(t, t), KIND.get(want_types[c], want_types[c])
        if a != b:
            problems.append(f"type {c}: {t} vs {want_types[c]}")
        elif t != want_types[c] and a == "int":
            if {t, want_types[c]} - {"int", "integer"}:
                problems.append(f"width {c}: {t} vs {want_types[c]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    _, a = rows_of(spark_df.columns, [tuple(r) for r in got])
    names, b = rows_of(want_names, want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        close = rows_of(spark_df.columns, [tuple(r) for r in got], 9)[1] == rows_of(want_names, want, 9)[1]
        problems.append(f"values differ ({'last digits only' if close else 'really'}) in {len(bad)} rows, "
                        f"{names}: {bad[0] if bad else (a[-1:], b[-1:])}")
    return "; ".join(problems)
