"""Run a query and its SQL side by side."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def kind(values) -> str:
    names = {type(v).__name__ for v in values if v is not None}
    return "/".join(sorted(names))


def differences(frame, con, sql: str) -> list[str]:
    """What differs between a Spark frame and the result of the SQL."""
    columns = sorted(frame.columns)
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return [f"columns {columns} against {sorted(names)}"]
    order = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    out = []
    if len(got) != len(want):
        out.append(f"rows {len(got)} against {len(want)}")
    for i, c in enumerate(columns):
        a, b = kind(r[i] for r in got), kind(r[i] for r in want)
        if a != b:
            out.append(f"type of {c}: {a} against {b}")
    def key(r):
        return tuple("" if v is None else repr(v) for v in r)
    got.sort(key=key)
    want.sort(key=key)
    if got != want:
        extra = list(set(got) - set(want))[:3]
        missing = list(set(want) - set(got))[:3]
        n = len(set(got) ^ set(want))
        out.append(f"{n} rows differ: only Spark {extra}, only SQL {missing}")
    return out
