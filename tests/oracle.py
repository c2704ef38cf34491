"""Run a query and its SQL on the same tables and compare the results."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, int)):
        return v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (float, Decimal)):
        return ("f", round(float(v), 6) + 0.0)
    return repr(v)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def kind(t: str) -> str:
    t = t.upper()
    for names, k in ((("BIGINT", "LONG"), "bigint"), (("INT",), "int"), (("DOUBLE",), "double"),
                     (("VARCHAR", "STRING"), "string"), (("DATE",), "date"), (("BOOL",), "bool")):
        if any(t == n or t.startswith(n) for n in names):
            return k
    return t


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty when names, types, row counts and values agree."""
    ref = con.sql(sql)
    found = []
    ours = {c: kind(t) for c, t in df.dtypes}
    theirs = {c: kind(str(t)) for c, t in zip(ref.columns, ref.types)}
    if ours != theirs:
        found.append(f"schema {set(ours.items()) ^ set(theirs.items())}")
    a, b = _bag(df.columns, df.collect()), _bag(ref.columns, ref.fetchall())
    if not sum(b.values()):
        found.append("no rows")
    if sum(a.values()) != sum(b.values()):
        found.append(f"rows {sum(a.values())} != {sum(b.values())}")
    if a != b:
        found.append(f"spark only {list((a - b).items())[:3]} sql only {list((b - a).items())[:3]}")
    return found
