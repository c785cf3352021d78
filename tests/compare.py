"""Compare query results with DuckDB, column by column and row by row."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def kind(value) -> str:
    return "date" if type(value) is dt.date else type(value).__name__


def normal(value):
    return round(value, 9) + 0.0 if isinstance(value, float) else value


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, Counter(tuple(normal(v) for v in row) for row in frame.select(*(f"`{n}`" for n in names)).collect())


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(normal(row[i]) for i in order) for row in cursor.fetchall())
    return [columns[i] for i in order], rows


def differences(frame, con, sql) -> list[str]:
    names, got = spark_rows(frame)
    expected_names, expected = duckdb_rows(con, sql)
    if names != expected_names:
        return [f"columns {names} != {expected_names}"]
    found = []
    for label, rows in (("only spark", got - expected), ("only duckdb", expected - got)):
        if rows:
            found.append(f"{label}: {sum(rows.values())} of {sum(expected.values())}, e.g. {next(iter(rows))}")
    kinds = [
        {kind(row[i]) for rows in (got, expected) for row in rows if row[i] is not None} for i in range(len(names))
    ]
    found += [f"types of {name}: {k}" for name, k in zip(names, kinds) if len(k) > 1]
    return found
