"""Compare a query's rows with its SQL counterpart, run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, int) and not isinstance(value, bool):
        return repr(float(value))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return None if value is None else str(value)


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    found = con.execute(sql)
    names, expected = bag([d[0] for d in found.description], found.fetchall())
    got_names, got = bag(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names}, expected {names}"
    if got == expected:
        return None
    extra, lacking = got - expected, expected - got
    return (
        f"{sum(got.values())} rows, expected {sum(expected.values())}; "
        f"extra {list(extra)[:3]}, lacking {list(lacking)[:3]}"
    )
