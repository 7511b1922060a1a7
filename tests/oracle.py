"""Run registered queries next to their SQL and compare the rows.

``python tests/oracle.py /root/testdata/sf0.01 [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect_to(files: dict[str, str]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table, path in files.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    return connect_to({table: f"{folder}/{table}.parquet" for table in TABLES})


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value) if isinstance(value, (int, str, bool)) or value is None else f"{type(value).__name__}:{value}"


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree on column names, kinds and rows."""
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    if sorted(frame.columns) != sorted(theirs_columns):
        return f"columns {sorted(frame.columns)} against {sorted(theirs_columns)}"
    ours, theirs = _rows(frame.columns, frame.collect()), _rows(theirs_columns, result.fetchall())
    if len(ours) != len(theirs):
        extra = [r for r in ours if r not in set(theirs)][:2]
        return f"{len(ours)} rows against {len(theirs)}; e.g. {extra} / {[r for r in theirs if r not in set(ours)][:2]}"
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    if not ours:
        return "no rows"
    return f"{len(wrong)} of {len(ours)} rows differ, e.g. {wrong[0]}" if wrong else ""


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from smeltery import build_session

    spark, con, failures = build_session(cpus=8), connect(folder), 0
    sqls = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            built = time.time() - start
            found = difference(frame, con, sqls[name]) if name in sqls else f"no sql, {frame.count()} rows"
        except Exception as error:  # noqa: BLE001
            found, built = f"{type(error).__name__}: {str(error)[:600]}", 0
        failures += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:28s} {built:6.1f} {time.time() - start:6.1f}s {found}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
