"""Run queries on Spark and their SQL on DuckDB and compare the rows.

    python -m checks.compare SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from checks.oracle import build
from checks.queries import QUERIES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def cell(value):
    """Floats to six digits, so that the last bit of a sum does not matter."""
    if isinstance(value, float):
        return float(f"{value:.6g}") + 0.0
    return value


def table_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, con, sf: str, name: str, sql: str) -> str:
    """'' if both sides agree, else what differs."""
    df = QUERIES[name](spark, sf)
    ours = table_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = table_rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first: {str(wrong[0])[:600]}" if wrong else ""


if __name__ == "__main__":
    from pithy.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    session, connection, statements = local_session(8), connect(sf_dir), build()
    for query in wanted or QUERIES:
        begin = time.time()
        if query in statements:
            verdict = differences(session, connection, sf_dir, query, statements[query]) or "ok"
        else:
            verdict = f"rows only: {QUERIES[query](session, sf_dir).count()}"
        print(f"{query:25s} {time.time() - begin:6.1f}s  {verdict}", flush=True)
