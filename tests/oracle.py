"""Compare a registered query with its SQL on DuckDB, row by row, in any order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def family(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, Decimal):
        return "decimal"
    if isinstance(value, dt.datetime):
        return "timestamp"
    if isinstance(value, dt.date):
        return "date"
    return type(value).__name__


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(canonical(r[i]) for i in order) for r in rows),
    )


def loose(counter: Counter, digits: int = 9) -> Counter:
    out: Counter = Counter()
    for row, n in counter.items():
        out[tuple(float(f"{v:.{digits}g}") if isinstance(v, float) else v for v in row)] += n
    return out


def compare(df, con, sql: str) -> tuple[str, str]:
    """(verdict, detail); verdict is ok, close (floats differ in the last digits) or bad."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return "bad", f"columns {got_cols} != {want_cols}"
    types = {}
    for side, rows in (("got", got), ("want", want)):
        for row in rows:
            for c, v in zip(got_cols, row, strict=True):
                if v is not None:
                    types.setdefault(c, {}).setdefault(side, set()).add(family(v))
    mixed = {c: t for c, t in types.items() if len(t) == 2 and t["got"] != t["want"]}
    if mixed:
        return "bad", f"types {mixed}"
    n = sum(got.values())
    if got == want:
        return "ok", f"{n} rows"
    if loose(got) == loose(want):
        return "close", f"{n} rows"
    a, b = got - want, want - got
    return "bad", (
        f"{n} vs {sum(want.values())} rows; only got {sum(a.values())}: "
        f"{sorted(a, key=str)[:2]}; only want {sum(b.values())}: {sorted(b, key=str)[:2]}"
    )
