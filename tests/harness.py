"""Compare a registered query with its SQL on the same tables, cell by cell."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return con


def cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0 if value else 0.0)
    return repr(value)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> str:
    """Empty if both give the same columns and the same bag of rows."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns: spark {sorted(frame.columns)}, sql {sorted(names)}"
    ours, theirs = bag(frame.columns, frame.collect()), bag(names, found.fetchall())
    if ours == theirs:
        return "" if ours else "no rows"
    extra, lacking = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; columns {sorted(names)}\n"
        f"  only spark {extra}\n  only sql   {lacking}"
    )
